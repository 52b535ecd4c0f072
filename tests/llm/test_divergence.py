"""The divergence audit against a plain version."""

import collections
import re

import numpy as np
import pytest

from reelspark.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _n int, Row int, Column int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=10, top=10):
    docs = [(lang or "", source or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = collections.Counter(t for d in own for t in set(d[2]))
        kept = [t for t, n in held.items() if n >= least]
        sources = sorted({d[1] for d in own})
        counts = {s: collections.Counter(t for d in own if d[1] == s for t in d[2]) for s in sources}
        counts[None] = collections.Counter(t for d in own for t in d[2])

        def share(s):
            total = sum(counts[s][t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (counts[s][t] + 2) // total for t in kept}

        p = {s: share(s) for s in counts}

        def far(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [(o, sum(far(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, far(p[s][t], p[None][t])) for t in kept if counts[s][t] and p[s][t] > p[None][t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])}
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    assert result(divergence.divergence(docs)) == brute(rows)


def test_odd_rows(spark):
    common = "Übung MACHT den Meister x1y2 a_b"
    rows = [(i % 7, f"{common} {'w' * (i % 3)} é\x00É z{i}", "de", f"s{i % 4}") for i in range(40)]
    rows += [(None, None, None, None), (1, "", "de", "empty"), (1, "", "de", "empty"), (2, None, "de", None)]
    rows += [(3, "nothing in common", "en", s) for s in ("a", "b", "c")]
    rows += [(4, "alone " * 30_000, "fr", "only"), (5, "k" * 300_000 + " alone", "de", "\U0001f600")]
    docs = spark.createDataFrame([(*r, 1, 1, 1, 1) for r in rows], SCHEMA)
    got = result(divergence.divergence(docs))
    assert got == brute(rows)
    assert ("en", "a", "pair", "b", 0, 1) in got and ("en", "a", "pair", "c", 0, 2) in got
    assert divergence.divergence(docs.limit(0)).count() == 0
    assert divergence.divergence(docs).columns == ["lang", "source", "part", "item", "value", "rank"]


def test_many_sources_and_terms(spark):
    """More than one page of rows and of columns, one source with a third of all rows."""
    random = np.random.default_rng(5)
    names = ["".join(chr(97 + int(c)) for c in random.integers(0, 26, 4)) for _ in range(60)]
    rows = []
    for i in range(300):
        source = "hot" if i % 3 == 0 else f"s{random.integers(11)}"
        rows.append((i, " ".join(names[min(59, int(x))] for x in random.exponential(12, 8)), "en", source))
    docs = spark.createDataFrame([(*r, 1, 1, 1, 1) for r in rows], SCHEMA)
    small = divergence.Shape(rows=2, columns=4, levels=1)
    assert result(divergence.divergence(docs, shape=small, held=5)) == brute(rows)


def test_shares_are_exact_for_large_totals():
    count = np.array([2, 3, 7_000_000_000_000, 8_999_999_999_999_999], dtype=np.int64)
    total = 8_999_999_999_999_999
    assert divergence.shares(count, total).tolist() == [1 + 1_000_000_000 * int(c) // total for c in count]


@pytest.mark.parametrize("width", [1, 5, 8])
def test_empty_quadrants_are_priced(width):
    totals = np.array([20, 30, 9], dtype=np.int64)
    empty = np.empty(0, dtype=np.int64)
    page = divergence.Page(divergence.SHAPE, empty, empty, empty, totals)
    p = divergence.shares(np.full(3, 2), totals)
    assert (divergence.walk(page, page, width) == width * divergence.gap(p[:, None], p[None, :])).all()
    assert not page.leaves
