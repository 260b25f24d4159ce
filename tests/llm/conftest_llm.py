"""Texts that the tests of several operators share."""

import os

import pyarrow.parquet as pq

FOLDER = "/root/testdata/sf0.01"
#: Texts that every operator must bear: null, empty, blanks, one letter, very long, repeated.
ODD = [None, "", " \n\t ", "a", "wörd " * 30_000, "x" * 50_000, "same text here", "same text here", "ümlaut — dash 🙂 end"]


def fixture_texts(n):
    """The first texts of the small documents table, as a fixture."""
    if not os.path.isdir(FOLDER):
        return []
    return pq.read_table(f"{FOLDER}/documents.parquet", columns=["text"]).column(0).to_pylist()[:n]
