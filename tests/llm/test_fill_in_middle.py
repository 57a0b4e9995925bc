"""Cuts, rotations and exact restoration."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm.fill_in_middle import Sentinels, exchange, fill_in_middle, rearranged, restore, restored, reverse

ODD = [
    (1, None), (2, ""), (3, "\n"), (4, "one line"), (5, "a\nb\n\nc"), (5, "a\nb\n\nc"), (None, "x\ny\n"), (6, "has <M> in it\n"),
    (7, "é\U0001f600\nß\n" * 5000), (8, "x" * 300_000), (9, "\n" * 1000), (10, "<\n<P\nP>\nS>\n"), (11, "\r\n \x00\n z"),
]


def expected(key, text, percent=100, spm_percent=50, seed=7):
    """The contract's own words, by concatenation."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm_percent:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_blocks_change_places_in_the_buffer():
    rnd = random.Random(3)
    for size in (0, 1, 2, 5, 1000, 200_001):
        buffer = bytearray(rnd.randbytes(size))
        start, middle, stop = sorted(rnd.randint(0, size) for _ in range(3))
        before = bytes(buffer)
        reverse(buffer, start, stop)
        assert buffer == before[:start] + before[start:stop][::-1] + before[stop:]
        reverse(buffer, start, stop)
        exchange(buffer, start, middle, stop)
        assert buffer == before[:start] + before[middle:stop] + before[start:middle] + before[stop:]
        buffer.append(0)  # no view of it is left


@pytest.mark.parametrize("marks", [Sentinels(), Sentinels("⟨p⟩", "suffix:", "|")])
def test_rotations_are_undone_exactly(marks):
    marks, rnd = marks.checked(), random.Random(4)
    pieces = [b"<", b"<P", b"P>", b">", b"\n", b"ab", "é".encode(), b"suffix", b"M>"]
    for _ in range(500):
        text = b"".join(rnd.choices(pieces, k=rnd.randint(0, 12)))
        if any(m in text for m in marks):
            continue
        first, second = sorted(rnd.randint(0, len(text)) for _ in range(2))
        for form in ("psm", "spm", "plain"):
            assert restored(rearranged(text, first, second, form, marks), form, marks) == text


@pytest.mark.parametrize("marks", [("", "b", "c"), ("ab", "xaby", "c"), ("aba", "x", "y"), ("ab", "bc", "d"), ("a", "a", "b")])
def test_sentinels_that_make_each_other_up_are_refused(marks):
    with pytest.raises(ValueError):
        Sentinels(*marks).checked()


def odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    return docs.select("*", *[F.lit("x").alias(n) for n in ("n", "form", "output", "restored", "0", "1")])


@pytest.mark.parametrize("percent, spm_percent", [(100, 50), (50, 0), (0, 50), (100, 100)])
def test_odd_texts(spark, percent, spm_percent):
    changed = restore(fill_in_middle(odd(spark), percent=percent, spm_percent=spm_percent))
    found = sorted(map(tuple, changed.collect()), key=repr)
    want = [(k, *expected(k, t, percent, spm_percent), t or "") for k, t in ODD]
    assert found == sorted(want, key=repr)


def test_other_units_keep_and_no_rows(spark):
    docs = odd(spark)
    cut = restore(fill_in_middle(docs, unit=r"\s*\S+", keep=("text", "0")))
    assert all(r["restored"] == (r["text"] or "") and r["0"] == "x" for r in cut.collect())
    assert cut.where("doc_id = 5 AND n = 3").count() == 2
    assert restore(fill_in_middle(docs.limit(0))).count() == 0
    by_name = docs.select(F.concat(F.lit("k"), "doc_id").alias("id"), "text")
    assert fill_in_middle(by_name, key="id", seed="s").where("id = 'k4'").first()[1:] == expected("k4", "one line", seed="s")


def test_restore_takes_missing_columns_of_rows_as_plain(spark):
    rows = spark.createDataFrame([(None, None), ("ab", None), ("<P>a<S><M>b\n", "psm")], "output string, form string")
    assert [r["restored"] for r in restore(rows).collect()] == ["", "ab", "ab\n"]
