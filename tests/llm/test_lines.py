"""Line dedup: rows that share an id, short lines, edits that grow with the line."""

import random

import pytest
from pyspark.sql import functions as F

from eventlake.llm import line_dedup


def texts(spark, rows, **options):
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, n int")
    return [r.text for r in line_dedup.dedup_lines(docs, **options).orderBy("n").collect()]


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_that_share_an_id_keep_their_own_lines(spark, doc_id):
    unique = [f"line number {n} that stands in one text alone, {n * n}" * (n + 1) for n in range(4)]
    common = "a line that several of the texts have at one place"
    rows = [(doc_id, f"{u}\n{common}\n{u[::-1]}") for u in unique]
    rows.append((doc_id, f"{unique[0][::-1]} and more of it all\nwhat only the last one says, at the common place\nend of it all and nothing else"))
    found = texts(spark, rows)
    assert found[-1] == rows[-1][1]
    assert all(u in t and u[::-1] in t for u, t in zip(unique, found))
    assert sum(common in t for t in found) == 1


def test_short_repeats_go_and_blank_lines_stay(spark):
    rows = [(1, "Les.\n\nLes.\n  \nLet."), (2, "Les.\n\n\t\nfish"), (3, "fish"), (None, "Let.")]
    assert texts(spark, rows) == ["Les.\n\n  ", "\n\t\nfish", "", "Let."]
