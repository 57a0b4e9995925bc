"""Training, choosing and judging classifiers with Spark ML."""

from millrace.models.certify import hinge_gains, logistic_gradient, versus_majority
from millrace.models.evaluate import (
    accuracy,
    auc,
    binary_report,
    classification_report,
    confusion_matrix,
    confusion_pivot,
)
from millrace.models.features import (
    CategoryModel,
    ImputedStringIndexer,
    PairwiseProduct,
    SquaredFeatures,
    assemble,
    standard_scale,
    typed_stages,
)
from millrace.models.fourier import FourierFeatures, FourierModel
from millrace.models.nodes import SCHEMA as NODE_SCHEMA
from millrace.models.nodes import predict_by_nodes, reached_leaves, tree_nodes
from millrace.models.select import (
    decide,
    evaluate_matrix,
    final_report,
    perturbation_test,
    select_best,
)
from millrace.models.train import (
    best_params,
    build_pipeline,
    cross_validate,
    estimator,
    fit,
    param_grid,
    predict,
)

__all__ = [name for name in dir() if not name.startswith("_")]
