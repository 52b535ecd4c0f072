"""Recommendations for all users and similar titles for all titles.

Nothing is scored as users x catalog. Bonuses depend only on genre and director, so
inside a list of equal bonus the rating decides. A user's best N titles are therefore
among the first ``N + watched in that list`` entries of a few ranked lists: the whole
catalog, each favourite genre, each favourite director, and each pair of both.
The lists are ranked once; users fetch entries by (list, rank).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.functions.exprs import has_value
from reelspark.operators.spread import lookup_join, rank_within, stored, top_per_key

# List sizes of a profile.
N_GENRES, N_DIRECTORS, N_TITLES = 3, 2, 4

# Score shown to users without history.
COLD_START_SCORE = 85
COLD_START_REASON = "🔥 Trending Global Top Pick — Acclaimed by critics"

# Titles that one task compares with the heads of their lists, and the measured bytes of
# heads up to which they are broadcast.
TITLES_PER_TASK, HEADS_BYTES = 20_000, 16 << 20

_SEP = "\x01"


def _list_key(*parts: Column) -> Column:
    return F.concat_ws(_SEP, *(F.coalesce(p, F.lit("\x00")) for p in parts))


def watched_pairs(events: DataFrame) -> DataFrame:
    """Distinct (user, title) over events of any type that name a title."""
    return (
        events.where(has_value(events, "content_id") & F.col("user_id").isNotNull())
        .select("user_id", "content_id")
        .distinct()
    )


def _with_catalog(pairs: DataFrame, content: DataFrame, ordinal: str) -> DataFrame:
    catalog = content.select("content_id", "genre", "director", "title", F.col(ordinal).alias("_ord"))
    return pairs.join(catalog, "content_id")


def _favourites(known: DataFrame, column: str, k: int) -> DataFrame:
    """A user's k most frequent values; ties keep catalog order."""
    counted = (
        known.where(F.col(column).isNotNull())
        .groupBy("user_id", column)
        .agg(F.count("*").alias("n"), F.min("_ord").alias("_first"))
    )
    return top_per_key(counted, "user_id", [F.desc("n"), F.col("_first")], k, "place").select(
        "user_id", F.col(column).alias("value"), "n", "place"
    )


def _packed(favourites: DataFrame, name: str) -> DataFrame:
    entries = F.sort_array(F.collect_list(F.struct("place", "value", "n")))
    return favourites.groupBy("user_id").agg(entries.alias(name))


def _profiles(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Per user: favourite genres and directors with their counts, titles known."""
    genres = _packed(_favourites(known, "genre", N_GENRES), "_genres")
    directed = known.where(F.col("director") != "")
    directors = _packed(_favourites(directed, "director", N_DIRECTORS), "_directors")
    n_known = known.groupBy("user_id").agg(F.count("*").alias("_n_known"))
    empty = F.array().cast("array<struct<place:int,value:string,n:bigint>>")
    return (
        pairs.groupBy("user_id")
        .agg(F.count("*").alias("total_watched_count"))
        .join(n_known, "user_id", "left")
        .join(genres, "user_id", "left")
        .join(directors, "user_id", "left")
        .select(
            "user_id",
            "total_watched_count",
            F.coalesce("_n_known", F.lit(0)).alias("_n_known"),
            F.coalesce("_genres", empty).alias("_genres"),
            F.coalesce("_directors", empty).alias("_directors"),
        )
    )


def user_profiles(events: DataFrame, content: DataFrame, ordinal: str = "content_id") -> DataFrame:
    pairs = watched_pairs(events)
    known = _with_catalog(pairs, content, ordinal)
    packed = F.sort_array(F.collect_list(F.struct("place", "title")))
    titles = (
        top_per_key(known, "user_id", [F.col("_ord")], N_TITLES, "place")
        .groupBy("user_id")
        .agg(packed["title"].alias("watched_titles"))
    )
    return (
        _profiles(pairs, known)
        .join(titles, "user_id", "left")
        .select(
            "user_id",
            F.col("_genres")["value"].alias("favorite_genres"),
            F.col("_directors")["value"].alias("favorite_directors"),
            F.coalesce("watched_titles", F.array().cast("array<string>")).alias("watched_titles"),
            "total_watched_count",
        )
    )


def _ranked_lists(content: DataFrame, ordinal: str) -> DataFrame:
    """Catalog entries ranked by (rating desc, catalog order) in each of their lists."""
    has_director = F.coalesce(F.col("director") != "", F.lit(False))
    lists = F.array_compact(
        F.array(
            _list_key(F.lit("all")),
            _list_key(F.lit("genre"), F.col("genre")),
            F.when(has_director, _list_key(F.lit("director"), F.col("director"))),
            F.when(has_director, _list_key(F.lit("pair"), F.col("genre"), F.col("director"))),
        )
    )
    entries = content.select(
        F.explode(lists).alias("list_key"),
        "content_id",
        "title",
        "genre",
        "content_type",
        F.coalesce(F.col("rating").cast("double"), F.lit(7.0)).alias("rating"),
        "director",
        F.col(ordinal).alias("_ord"),
    )
    return rank_within(entries, "list_key", [F.desc("rating"), F.col("_ord")], "list_rank")


def _wanted(profiles: DataFrame, known: DataFrame, top_n: int) -> DataFrame:
    """(user, list, rank) to fetch: N plus what the user has watched of that list.

    A user has at most 1 + 3 + 2 + 3 * 2 lists. How often a favourite genre and a
    favourite director meet is looked up; the other counts are in the profile.
    """
    entry = "struct<genre:string,director:string,n:bigint>"
    none = F.lit(None)
    whole = F.array(F.struct(none, none, F.col("_n_known"))).cast(f"array<{entry}>")
    genres = F.transform("_genres", lambda g: F.struct(g["value"], none, g["n"]).cast(entry))
    directors = F.transform("_directors", lambda d: F.struct(none, d["value"], d["n"]).cast(entry))
    pairs = F.flatten(
        F.transform(
            "_genres",
            lambda g: F.transform(
                "_directors", lambda d: F.struct(g["value"], d["value"], none).cast(entry)
            ),
        )
    )
    carried = [
        "user_id",
        F.col("_genres")["value"].alias("_fav_genres"),
        F.col("_directors")["value"].alias("_fav_directors"),
        "_n_known",
    ]
    lists = profiles.select(*carried, F.inline(F.concat(whole, genres, directors, pairs)))
    met = known.groupBy("user_id", "genre", "director").agg(F.count("*").alias("_met"))
    genre, director = F.col("genre"), F.col("director")
    list_key = (
        F.when(genre.isNull() & director.isNull(), _list_key(F.lit("all")))
        .when(director.isNull(), _list_key(F.lit("genre"), genre))
        .when(genre.isNull(), _list_key(F.lit("director"), director))
        .otherwise(_list_key(F.lit("pair"), genre, director))
    )
    watched = F.coalesce("n", "_met", F.lit(0))
    depth = F.sequence(F.lit(1).cast("bigint"), (watched + top_n).cast("bigint"))
    return lists.join(met, ["user_id", "genre", "director"], "left").select(
        "user_id",
        "_fav_genres",
        "_fav_directors",
        "_n_known",
        list_key.alias("list_key"),
        F.explode(depth).alias("list_rank"),
    )


def _match_score() -> Column:
    favourite = F.array_contains("_fav_genres", F.col("genre"))
    genre_bonus = F.when(F.get("_fav_genres", F.lit(0)) == F.col("genre"), 25.0).when(favourite, 15.0)
    directed = F.when(_liked_director(), 15.0)
    score = (
        F.lit(60.0)
        + (F.col("rating") - 5.0) * 4.0
        + F.coalesce(genre_bonus, F.lit(0.0))
        + F.coalesce(directed, F.lit(0.0))
    )
    return F.least(F.greatest(score, F.lit(50.0)), F.lit(99.0)).cast("int")


def _liked_director() -> Column:
    return (F.col("director") != "") & F.array_contains("_fav_directors", F.col("director"))


def _reason() -> Column:
    reasons = F.concat_ws(
        " • ",
        F.when(
            F.array_contains("_fav_genres", F.col("genre")),
            F.concat(F.lit("Matches your affinity for "), F.col("genre")),
        ),
        F.when(_liked_director(), F.concat(F.lit("Directed by "), F.col("director"))),
        F.when(
            F.col("rating") >= 8.5,
            F.concat(F.lit("Masterpiece rating ("), F.col("rating").cast("string"), F.lit("/10)")),
        ),
    )
    said = F.when(reasons == "", "Trending pick aligned with platform audience").otherwise(reasons)
    return F.concat(F.lit("⭐ "), F.col("match_score").cast("string"), F.lit("% Match • "), said)


def recommend_for_users(
    events: DataFrame, content: DataFrame, top_n: int = 5, ordinal: str = "content_id"
) -> DataFrame:
    """Top N unwatched titles for every user with history; users who have watched
    the whole catalog are offered all of it again."""
    pairs = watched_pairs(events)
    known = _with_catalog(pairs, content, ordinal)
    wanted = _wanted(_profiles(pairs, known), known, top_n)
    fetched = lookup_join(wanted, _ranked_lists(content, ordinal), ["list_key", "list_rank"])
    candidates = fetched.drop("list_key", "list_rank").dropDuplicates(["user_id", "content_id"])
    catalog_size = content.agg(F.count("*").alias("n")).scalar()
    watched = pairs.withColumn("_watched", F.lit(True))
    fresh = (
        candidates.join(watched, ["user_id", "content_id"], "left")
        .where(F.col("_watched").isNull() | (F.col("_n_known") >= catalog_size))
        .withColumn("match_score", _match_score())
    )
    best = top_per_key(
        fresh, "user_id", [F.desc("match_score"), F.desc("rating"), F.col("_ord")], top_n, "place"
    )
    return best.select(
        "user_id",
        "place",
        "content_id",
        "title",
        "genre",
        "content_type",
        "rating",
        "director",
        "match_score",
        _reason().alias("reason"),
    )


def cold_start(
    users: DataFrame, events: DataFrame, content: DataFrame, top_n: int = 5, ordinal: str = "content_id"
) -> DataFrame:
    """Users without history get the best rated titles: a list of N rows, attached
    to each user as one small array."""
    best = content.orderBy(F.desc("rating"), ordinal).limit(top_n)
    place = F.row_number().over(Window.orderBy(F.desc("rating"), ordinal))
    fields = ["place", "content_id", "title", "genre", "content_type", "rating", "director"]
    packed = (
        best.withColumn("place", place)
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("picks"))
        .scalar()
    )
    newcomers = users.select("user_id").join(watched_pairs(events).select("user_id").distinct(), "user_id", "left_anti")
    return (
        newcomers.withColumn("_picks", packed)
        .select("user_id", F.inline("_picks"))
        .withColumn("match_score", F.lit(COLD_START_SCORE))
        .withColumn("reason", F.lit(COLD_START_REASON))
    )


def similar_titles(content: DataFrame, top_n: int = 4, ordinal: str = "content_id") -> DataFrame:
    """The N most similar titles of every title.

    Similarity is 50, +35 for the same genre, +15 for the same director, plus four
    points per rating point above 7, at most 98. The best N are among the first N + 1
    of four lists (all, genre, director, pair), each ordered by the score it implies.
    The heads of the lists come to a title as arrays: by broadcast if measured small,
    else by joins that can be split.
    """
    adjustment = ((F.coalesce(F.col("rating").cast("double"), F.lit(7.0)) - 7.0) * 4).cast("int")
    catalog = content.select(
        "content_id", "title", "genre", "director", "rating", adjustment.alias("_adj"), F.col(ordinal).alias("_ord")
    )
    genre, director = F.col("genre"), F.col("director")

    def entry(bonus: int, *key: Column) -> Column:
        implied = F.least(F.col("_adj") + 50 + bonus, F.lit(98))
        return F.struct(_list_key(*key).alias("list_key"), implied.alias("_implied"))

    lists = F.array(
        entry(0, F.lit("all")),
        entry(35, F.lit("genre"), genre),
        entry(15, F.lit("director"), director),
        entry(50, F.lit("pair"), genre, director),
    )
    # a catalog of a few files must not be one task: each title meets up to 4 (N + 1) others
    catalog = stored(catalog)
    tasks = max(1, -(-catalog.count() // TITLES_PER_TASK))
    catalog = catalog.repartition(tasks, "content_id")
    listed = catalog.select("*", F.inline(lists))
    shown = F.struct(
        F.col("content_id").alias("similar_id"),
        F.col("title").alias("similar_title"),
        F.col("genre").alias("similar_genre"),
        F.col("director").alias("_similar_director"),
        F.col("rating").cast("double").alias("similar_rating"),
        F.col("_adj").alias("_similar_adj"),
        F.col("_ord").alias("_similar_ord"),
    )
    heads = top_per_key(listed, "list_key", [F.desc("_implied"), F.col("_ord")], top_n + 1, "_place")
    heads = stored(heads.groupBy("list_key").agg(F.collect_list(shown).alias("_heads")))
    everywhere = heads.where(F.col("list_key") == _list_key(F.lit("all"))).select("_heads").scalar()
    met = catalog.withColumn("_met", everywhere)
    held = F.aggregate("_heads", F.lit(0), lambda n, h: n + 96 + sum(
        F.coalesce(F.octet_length(h[c]), F.lit(0)) for c in ("similar_title", "similar_genre", "_similar_director")
    ))
    few = (heads.agg(F.sum(F.octet_length("list_key") + held)).first()[0] or 0) <= HEADS_BYTES
    for key in ((F.lit("genre"), genre), (F.lit("director"), director), (F.lit("pair"), genre, director)):
        keyed = met.withColumn("list_key", _list_key(*key))
        joined = keyed.join(F.broadcast(heads), "list_key", "left") if few else lookup_join(keyed, heads, ["list_key"], "left")
        met = joined.withColumn("_met", F.concat("_met", "_heads")).drop("list_key", "_heads")

    def scored(h: Column) -> Column:
        similarity = (
            F.lit(50)
            + F.when(genre.eqNullSafe(h["similar_genre"]), 35).otherwise(0)
            + F.when(director.eqNullSafe(h["_similar_director"]), 15).otherwise(0)
            + h["_similar_adj"]
        )
        best_first = (-F.least(similarity, F.lit(98))).alias("_sunk")
        return F.struct(best_first, h["_similar_ord"].alias("_similar_ord"), *(
            h[c].alias(c) for c in ("similar_id", "similar_title", "similar_genre", "similar_rating")
        ))

    # a title's candidates are cut to N inside its row, so that no task holds them all
    others = F.filter("_met", lambda h: F.col("content_id") != h["similar_id"])
    ranked = met.select("content_id", "title", F.array_sort(F.transform(others, scored)).alias("_ranked"))
    seen = F.transform("_ranked", lambda c: c["similar_id"])
    once = F.filter("_ranked", lambda c, i: ~F.array_contains(F.slice(seen, F.lit(1), i), c["similar_id"]))
    candidates = ranked.select("content_id", "title", F.inline(F.slice(once, 1, top_n))).withColumn(
        "similarity_score", -F.col("_sunk")
    )
    order = [F.desc("similarity_score"), F.col("_similar_ord")]
    # rows of one title id, if it repeats, share their candidates
    candidates = top_per_key(candidates, ["content_id", "similar_id"], order, 1, "_first")
    best = top_per_key(candidates, "content_id", order, top_n, "place")
    return best.select(
        "content_id",
        "title",
        "place",
        "similar_id",
        "similar_title",
        "similar_genre",
        "similar_rating",
        "similarity_score",
    )
