"""Words and sets that simple hashes confuse must be told apart."""

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import near_dup, substrings
from millrace.llm.words import Words
from tests.llm.test_operators import components


def thue_morse(n):
    """A word of two letters and its complement: equal under any polynomial hash modulo a power of two."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_word_hashes(n):
    for family in (0, 1):
        one, two = Words(pa.array(thue_morse(n)), lower=False).hashes(family)
        assert one != two
    one, two = (Words(pa.array(["some words here"]), lower=False).hashes(f) for f in (0, 1))
    assert not np.intersect1d(one, two).size


def test_near_duplicates_of_colliding_words(spark):
    a, b = thue_morse(1024)
    rows = [(1, f"{a} p q r s"), (2, f"{b} p q r s"), (3, f"{a} {a}"), (4, f"{b} {b}"), (5, f"{a} p q r s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.near_duplicates(frame, near_dup.Near(shingle=4)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == components(rows, 4)


def test_repeats_of_colliding_words(spark):
    a, b = thue_morse(1024)
    left, right = [f"l{i}" for i in range(20)], [f"r{i}" for i in range(20)]
    rows = [(1, " ".join([*left, a, *right])), (2, " ".join([*left, b, *right]))]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.mr_kept) for r in got) == rows
