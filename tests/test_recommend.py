"""Ranked lists against full scoring on random catalogs."""

import random

import pytest

from reelspark.operators import recommend

CONTENT = (
    "content_id int, title string, genre string, content_type string, rating double, director string"
)


def random_case(seed):
    rng = random.Random(seed)
    n = rng.randint(3, 40)
    catalog = [
        (
            i,
            f"t{i}",
            rng.choice(["Drama", "Sci-Fi", "Noir"]),
            "Movie",
            round(rng.choice([5.0, 6.2, 6.8, 7.5, 8.5, 9.4]), 1),
            rng.choice(["Ann", "Bo", "Cy", "", "Di"]),
        )
        for i in range(n)
    ]
    events = []
    for user in range(6):
        k = n if user == 0 else rng.randint(0, n)
        for cid in rng.sample(range(n), k):
            events.append((user, cid))
        if user == 1:
            events.append((user, 9999))
    return catalog, events


def favourites(values, k):
    counts = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    return sorted(counts, key=lambda v: -counts[v])[:k]


def brute_force(catalog, events, top_n):
    out = {}
    for user in {u for u, _ in events}:
        watched = {c for u, c in events if u == user}
        seen = [c for c in catalog if c[0] in watched]
        genres = favourites([c[2] for c in seen], 3)
        directors = favourites([c[5] for c in seen if c[5]], 2)
        candidates = [c for c in catalog if c[0] not in watched] or catalog
        scored = []
        for c in candidates:
            score = 60.0 + (c[4] - 5.0) * 4.0
            if c[2] in genres:
                score += 25.0 if c[2] == genres[0] else 15.0
            if c[5] and c[5] in directors:
                score += 15.0
            scored.append((int(min(99, max(50, score))), c[4], c[0]))
        scored.sort(key=lambda s: (-s[0], -s[1], s[2]))
        out[user] = [(cid, match) for match, _, cid in scored[:top_n]]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_lists_equal_full_scoring(spark, seed):
    catalog, events = random_case(seed)
    content = spark.createDataFrame(catalog, CONTENT)
    seen = spark.createDataFrame(events, "user_id int, content_id int")
    rows = recommend.recommend_for_users(seen, content, 5).orderBy("user_id", "place").collect()
    got = {}
    for r in rows:
        got.setdefault(r.user_id, []).append((r.content_id, r.match_score))
    assert got == brute_force(catalog, events, 5)


@pytest.mark.parametrize("seed", range(3))
def test_similar_equals_full_scoring(spark, seed):
    catalog, _ = random_case(seed)
    content = spark.createDataFrame(catalog, CONTENT)
    rows = recommend.similar_titles(content, 4).orderBy("content_id", "place").collect()
    got = {}
    for r in rows:
        got.setdefault(r.content_id, []).append((r.similar_id, r.similarity_score))
    for a in catalog:
        scored = [
            (
                min(98, 50 + 35 * (a[2] == b[2]) + 15 * (a[5] == b[5]) + int((b[4] - 7.0) * 4)),
                b[0],
            )
            for b in catalog
            if b[0] != a[0]
        ]
        scored.sort(key=lambda s: (-s[0], s[1]))
        assert got[a[0]] == [(cid, s) for s, cid in scored[:4]]


def test_cold_start_offers_best_rated(spark):
    catalog, events = random_case(1)
    content = spark.createDataFrame(catalog, CONTENT)
    seen = spark.createDataFrame(events, "user_id int, content_id int")
    users = spark.createDataFrame([(u,) for u in range(100, 103)], "user_id int")
    rows = recommend.cold_start(users, seen, content, 3).collect()
    best = sorted(catalog, key=lambda c: (-c[4], c[0]))[:3]
    assert len(rows) == 9
    assert {r.match_score for r in rows} == {85}
    assert {(r.place, r.content_id) for r in rows} == {(i + 1, c[0]) for i, c in enumerate(best)}


def test_similar_titles_are_cut_inside_their_row(spark, monkeypatch):
    """Candidates of a title meet in its row: nothing groups or shuffles all of them, and
    a catalog of one small file is many tasks. Both ways to join give the same rows."""
    monkeypatch.setattr(recommend, "TITLES_PER_TASK", 7)
    catalog, _ = random_case(2)
    catalog += [(100, "x", None, "Movie", 9.0, None), (101, "y", None, "Movie", None, None), catalog[0]]
    content = spark.createDataFrame(catalog, CONTENT)
    similar = recommend.similar_titles(content, 4)
    plan = similar._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "Aggregate [content_id" not in plan
    rows = sorted(map(tuple, similar.collect()), key=str)
    monkeypatch.setattr(recommend, "HEADS_BYTES", 0)
    assert rows == sorted(map(tuple, recommend.similar_titles(content, 4).collect()), key=str)
    assert len({(r[0], r[3]) for r in rows}) == len(rows) == 4 * (len(catalog) - 1)
