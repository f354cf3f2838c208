from __future__ import annotations

import re

import pytest

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    """A-Z only."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture
def documents(spark, tmp_path):
    """Documents read from files: (doc_id, text[, lang, source]) and a clashing column."""

    def make(rows, name="documents"):
        full = [(*r, *(None,) * (4 - len(r)), "x", 1) for r in rows]
        kinds = "doc_id long, text string, lang string, source string, size string, row int"
        path = f"{tmp_path}/{name}.parquet"
        spark.createDataFrame(full, kinds).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return make
