"""Token files: exact round trips, the public format, seeking, damage."""

import io
import random
import zlib
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.queries import op13_token_files
from millrace.llm.token_files import Encoder, FileReader, FileWriter, read_documents, read_token_files, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
DEFINITION = open(PATH, encoding="utf-8").read()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()


def test_pieces_between_spaces_give_the_ids_of_the_whole_text(tokenizer):
    rnd = random.Random(5)
    parts = [" ", "  ", "\n", "\t", " ", " ", "\x85", "e", "́", "̣", "é", "Σ", "ΑΣ", "İ", "'s", "'", "don't", "9", "12",
             "#", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "ﬁ", "가", "가", "漢字", "\U0001f600", "\x00", "_", "Ab"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(3000)] + ["", "x" * 5000 + " y", " ́ a"]
    texts += [" ".join(rnd.choices(["Word", "word.", "WORD!?", "x,y", "The", "the...", ".", "a;", "end.\vNext", "q\x1fr", "Élan", "ÀÿÞßÖ,", "a×b", "ªµº", "naïve!", "nai\u0308ve", "straße.", "Ārd", "ñ÷", "it'", "it's", "a***", "b<|", "c$%&'()", "d_", "e`~{}"], k=9)) for _ in range(300)]
    raw, want = [t.encode() for t in texts], [ids_of(tokenizer, t) for t in texts]
    encode = Encoder(DEFINITION, 2)
    assert encode._direct and encode(raw[:1000]) + encode(raw[1000:]) == want
    encode._direct = False
    encode._forget()
    assert encode(raw) == want and encode([]) == []
    assert not Encoder(DEFINITION.replace('"Lowercase"', '"NFD"'), 2)._direct


def written(documents, frame_ids):
    out = io.BytesIO()
    writer = FileWriter(out, frame_ids)
    for i, ids in enumerate(documents):
        writer.add(pa.array([i], pa.int64()), [ids])
    totals = writer.close()
    return out, totals


def test_file_is_seekable_and_checked():
    rnd = np.random.default_rng(1)
    documents = [rnd.integers(0, 49408, n).astype("<u4").tobytes() for n in (1, 7, 0, 100, 99, 1, 350, 3, 3)]
    out, totals = written(documents, 100)
    assert totals == (9, sum(map(len, documents)) // 4)
    # any decoder reads the ids, as the rest is skippable
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert plain == b"".join(documents)
    reader = FileReader(out)
    assert [reader.document(i) for i in range(9)] == documents and reader.keys.to_pylist() == list(range(9))
    reader = FileReader(out)
    assert reader.document(4) == documents[4] and reader.frames_read == 1
    assert reader.document(6) == documents[6] and reader.frames_read == 5
    # a flipped bit in a frame is found when the frame is read, and only then
    broken = bytearray(out.getvalue())
    at = int(reader._at[2]) + int(reader._packed[2]) // 2
    broken[at] ^= 1
    reader = FileReader(io.BytesIO(bytes(broken)))
    assert reader.document(0) == documents[0]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        [reader.document(i) for i in range(9)]
    with pytest.raises(ValueError):
        FileReader(io.BytesIO(out.getvalue()[:-1]))


ODD = [
    (9, "nine"), (3, None), (2, ""), (2, ""), (None, "none"), (4, "word " * 70_000), (5, "One two"), (5, "one  TWO"), (5, "One two"), (-1, " \n"),
    (7, "z" * 20_000), (6, "<|endoftext|>"),
]


def odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    return docs.select("*", *[F.lit("x").alias(n) for n in ("key", "copy", "place", "part", "start", "ids")])


@pytest.mark.parametrize("part_bytes", [100, 100_000, 1 << 30])
def test_round_trip_in_order_of_keys(spark, tokenizer, part_bytes):
    files = write_token_files(odd(spark).repartition(4), DEFINITION, end=2, frame_ids=1000, part_bytes=part_bytes)
    rows = sorted(read_token_files(files).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((k for k, _ in ODD), key=lambda k: (k is not None, k or 0))
    want = {(k, ids_of(tokenizer, t)) for k, t in ODD}
    assert {(r["doc_id"], bytes(r["ids"])) for r in rows} == want
    assert [r["start"] for r in rows] == [0, *accumulate(r["n_tokens"] for r in rows)][:-1]
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    listed = files.orderBy("part").collect()
    assert sum(r["n_docs"] for r in listed) == len(ODD)
    if part_bytes == 100:
        assert len(listed) > 3

    asked = spark.createDataFrame([(5,), (5,), (4,), (-1,), (77,), (None,)], "doc_id long")
    some = read_documents(files, asked).collect()
    assert sorted(map(tuple, some)) == sorted(tuple(r) for r in rows if r["doc_id"] in (5, 4, -1))
    assert read_documents(files, asked.limit(0)).count() == 0


def test_one_key_with_most_rows_is_split(spark):
    docs = spark.range(3000).selectExpr("IF(id % 3 = 0, id, 1L) AS doc_id", "'the same words in all of them' AS text")
    files = write_token_files(docs, DEFINITION, end=2, part_bytes=8000)
    assert max(r["n_docs"] for r in files.collect()) < 1200
    found = read_documents(files, spark.range(1, 2).toDF("doc_id"))
    assert found.count() == 2000 and found.select("start").distinct().count() == 2000


def test_no_rows_and_other_keys(spark, tokenizer):
    docs = odd(spark)
    files = write_token_files(docs.limit(0), DEFINITION, end=2)
    assert files.count() == 0 and read_token_files(files).count() == 0
    assert read_documents(files, docs.select("doc_id")).count() == 0
    named = docs.select(F.concat(F.lit("k"), "doc_id").alias("name"), "text")
    files = write_token_files(named, DEFINITION, end=7, key="name", part_bytes=1000)
    found = read_documents(files, spark.createDataFrame([("k9",)], "name string"), key="name").first()
    assert found["name"] == "k9" and bytes(found["ids"]) == ids_of(tokenizer, "nine")[:-4] + b"\x07\0\0\0"


def test_query_on_whole_tables(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    ids = [ids_of(tokenizer, t) for _, t in rows]
    starts = [0, *accumulate(len(x) // 4 for x in ids)]
    want = [(k, s, len(x) // 4, zlib.crc32(x)) for (k, _), s, x in zip(rows, starts, ids)]
    assert sorted(map(tuple, op13_token_files(spark, sf).collect())) == want
