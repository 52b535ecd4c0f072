"""Personal data in texts: fixed patterns, and spans learned from labelers that disagree.

Four kinds follow fixed patterns and always count. Further candidates are runs of letters
and digits, also joined by marks (``secret``), values after a word like "password"
(``password``), groups of digits such as local phone numbers and national ids
(``number``), and capitalised names after a title or a given name (``name``). Each kind
has labelers of its own, which vote: patterns, word lists and the characters around.
Expectation-maximisation over the vote patterns of a kind estimates how reliable each
labeler is without any labelled data. The resulting probabilities train a naive Bayes
classifier over the candidates' features, which decides all spans, also those on which
most labelers abstain.

All of it is built-in expressions. A text is read in place, without a shuffle; training
takes one aggregation whose result, vote patterns by features, has a fixed bound. The
expectation-maximisation itself runs on those few rows.

Defined cases: a null text is empty; no match gives empty spans, and their digest is
that of the empty string; spans of several kinds may overlap; candidates that overlap a
fixed span are no candidates; without candidates nothing is learned and nothing added;
repeated rows and null ids keep a row each; an empty table gives no rows; other columns
pass through ``redact`` untouched. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import text_of, unused

# The patterns match what the plain ones match; a match cannot start inside a run whose
# start failed, which saves rereading long runs, and loops that never give back are
# possessive, so long texts need no deep stack.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

HINT_WORDS = "password|passwd|pwd|passphrase|token|secret|key|apikey|bearer|credential|credentials|auth|login|access"
PLAIN_WORDS = "version|page|chapter|figure|section|article|release|build|isbn|model|issue|line"
PHRASE_WORDS = "password|passwd|pwd|passphrase|passcode|pin|secret"
NUMBER_WORDS = "phone|tel|telephone|call|mobile|cell|fax|contact|dial|ssn|social|security|passport|licence|license|id|text"
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Madam"
NAME_WORDS = "name|contact|dear|signed|patient|customer|regards|sincerely|attn|hello|hi"
GIVEN_NAMES = (
    "James|Mary|John|Patricia|Robert|Jennifer|Michael|Linda|William|Elizabeth|David|Barbara|Richard|Susan|Joseph|Jessica|"
    "Thomas|Sarah|Charles|Karen|Daniel|Nancy|Matthew|Lisa|Anthony|Emily|Peter|Anna|Maria|Laura|Julia|Paul|George|Alice"
)
PLACE_WORDS = "Street|Avenue|Road|Lane|University|College|Hospital|Park|Square|River|Lake|Island|County|School|Church"

# A joined run starts only where no earlier part of it stands, so each is read once.
RUN = (
    r"(?<![A-Za-z0-9])(?<![A-Za-z0-9][-_/+.])(?=[A-Za-z0-9_/+.-]{8})"
    r"(?=[A-Za-z]*+(?:[-_/+.][A-Za-z]++)*+[-_/+.]?[0-9])[A-Za-z0-9]++(?:[-_/+.][A-Za-z0-9]++)*+={0,2}"
)
HINTED_END = rf"(?<![A-Za-z0-9])(?i:{PHRASE_WORDS}|token|key|apikey|login|auth)[\"']?[\x20]{{0,2}}[=:][\x20]{{0,2}}[\"']?"
HINTED = rf"(?<=[=:\x20\"'])(?<=[=:][\x20]{{0,2}}[\"']?)(?<={HINTED_END})[^\s\"',;<>=:\[\]]{{4,}}+"
GROUPS = (
    r"(?<![0-9A-Za-z$.,/+-])(?<![0-9]\x20)(?:\([0-9]{2,5}\)[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,5}"
    r"|[0-9]{3}\x20[0-9]{3}\x20[0-9]{4}|[0-9]{3}\x20[0-9]{2}\x20[0-9]{4}"
    r"|(?=(?:[0-9][-.]?){7})[0-9]{1,5}(?:[-.][0-9]{2,7}){1,4}+)(?![0-9A-Za-z]|[\x20.-][0-9])"
)
_CAPITAL = r"\p{Lu}[\p{L}'’-]{1,30}+"
NAME = (
    rf"(?<![\p{{L}}0-9])(?:(?<=(?<![\p{{L}}])(?:{TITLES})\.?\x20){_CAPITAL}(?:\x20{_CAPITAL}){{0,2}}+"
    rf"|(?=\p{{Lu}})(?:{GIVEN_NAMES})\x20{_CAPITAL})"
)
CANDIDATE = rf"{HINTED}|{NAME}|{GROUPS}|{RUN}"

KINDS = ("email", "ip", "card", "phone")
ADDED = ("secret", "password", "number", "name")
#: Characters before a candidate that labelers see.
CONTEXT = 32
#: Buckets for the word before a candidate.
WORDS_BEFORE = 32

_BLOCK = 512


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once. Inside a lambda function an outside
    expression would be computed for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sums(values: Column) -> Column:
    """0 and the running sums."""
    start = F.array(F.lit(0))
    return F.aggregate(values, start, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))


def _running(lengths: Column) -> Column:
    """Sums of all earlier elements, in blocks so that work stays near linear."""

    def shifted(blocks: Column) -> Column:
        carried = F.slice(_sums(F.transform(blocks, lambda s: F.element_at(s, -1))), F.lit(1), F.size(blocks))
        pairs = F.zip_with(blocks, carried, lambda s, c: F.struct(s.alias("s"), c.alias("c")))
        return F.flatten(
            F.transform(
                pairs, lambda p: F.transform(F.slice(p["s"], F.lit(1), F.size(p["s"]) - 1), lambda v: v + p["c"])
            )
        )

    def summed(all_: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / _BLOCK).cast("int"))
        return F.transform(starts, lambda b: _sums(F.slice(all_, b * _BLOCK + 1, F.lit(_BLOCK))))

    return _let(_let(lengths, summed), shifted)


def _found(df: DataFrame, text: str, pattern: str, name: str, hint: str | None = None) -> DataFrame:
    """Add all matches as (start, end, match, before, after). ``hint`` is a text without
    which there can be no match."""
    hits = unused(df, f"{name}_hits")
    can = F.contains(F.col(text), F.lit(hint)) if hint else F.lit(True)
    none = F.array().cast("array<string>")
    df = df.withColumn(hits, F.when(can, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(none))

    def span(z: Column) -> Column:
        start = z["at"] + F.length(z["before"])
        return F.struct(
            start.alias("start"),
            (start + F.length(z["match"])).alias("end"),
            z["match"].alias("match"),
            F.right(z["before"], F.lit(CONTEXT)).alias("before"),
            F.left(z["after"], F.lit(1)).alias("after"),
        )

    def spans(both: Column) -> Column:
        # one part before each hit and one after the last
        found, parts = both["hits"], both["parts"]
        before, after = F.slice(parts, F.lit(1), F.size(found)), F.slice(parts, F.lit(2), F.size(found))
        at = _running(F.zip_with(before, found, lambda a, b: F.length(a) + F.length(b)))
        zipped = F.arrays_zip(at.alias("at"), found.alias("match"), before.alias("before"), after.alias("after"))
        return F.transform(zipped, span)

    both = F.struct(F.col(hits).alias("hits"), F.split(F.col(text), pattern, -1).alias("parts"))
    empty = F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>")
    return df.withColumn(name, F.when(F.size(hits) > 0, _let(both, spans)).otherwise(empty)).drop(hits)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.cast("double") <= 255)
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _validity(kind: str):
    return lambda span: _valid(kind, span["match"])


_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _plain(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    ).cast(_SPAN)


def with_base(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the spans of the fixed kinds, by start and kind."""
    own = {}
    for rank, (kind, pattern, hint) in enumerate(zip(KINDS, (EMAIL, IP, CARD, PHONE), ("@", ".", None, "+"))):
        own[kind] = unused(df, f"{name}_{kind}")
        df = _found(df, text, pattern, own[kind], hint)
        kept = F.filter(own[kind], _validity(kind))
        df = df.withColumn(own[kind], _plain(kept, kind, rank))
    return df.withColumn(name, F.array_sort(F.concat(*own.values()))).drop(*own.values())


def _kind(c: Column) -> Column:
    """The kind that a candidate might be, null where it can be none."""
    match, before = c["match"], c["before"]
    digit, letter = match.rlike("[0-9]"), match.rlike("[A-Za-z]")
    key = digit & letter & match.rlike(r"^[A-Za-z0-9_/+.=-]{12,}$")
    return (
        F.when(before.rlike(f"{HINTED_END}$") & ~key, "password")
        .when(digit & letter & (F.length(match) >= 8), "secret")
        .when(digit & ~letter & match.rlike("[\\x20().-]"), "number")
        .when(~digit & match.rlike(r"^\p{Lu}") & before.rlike(r"(?:^|\s)$"), "name")
    )


def with_candidates(df: DataFrame, text: str, base: str, name: str) -> DataFrame:
    """Add the candidates, with kind, votes and features, that no fixed span overlaps."""
    df = _found(df, text, CANDIDATE, name)
    free = _let(
        F.col(base),
        lambda spans: F.filter(
            name, lambda c: ~F.exists(spans, lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"]))
        ),
    )
    named = F.filter(
        F.transform(free, lambda c: c.withField("kind", _kind(c))), lambda c: c["kind"].isNotNull()
    )

    def described(c: Column) -> Column:
        votes = F.coalesce(*(F.when(c["kind"] == k, F.array_join(F.array(*_votes(c, k)), ",")) for k in ADDED))
        return F.struct(
            c["start"].alias("start"),
            c["end"].alias("end"),
            c["kind"].alias("kind"),
            votes.alias("votes"),
            F.transform(F.array(*_features(c)), lambda f: F.concat(c["kind"], F.lit("|"), f)).alias("features"),
        )

    return df.withColumn(name, F.transform(named, described))


def _share(c: Column, other: str) -> Column:
    """The share of characters that remain when all ``other`` ones go."""
    return F.length(F.regexp_replace(c["match"], other, "")) / F.length(c["match"])


def _digits(c: Column) -> Column:
    return F.length(F.regexp_replace(c["match"], "[^0-9]", ""))


def _changes(c: Column) -> Column:
    """How often letters and digits alternate."""
    return F.regexp_count(c["match"], F.lit("[A-Za-z][0-9]|[0-9][A-Za-z]"))


def _plain_parts(c: Column) -> Column:
    """How many parts of a joined run look like written words."""
    return F.regexp_count(c["match"], F.lit("(?<![A-Za-z0-9])[A-Za-z][a-z]{2,}(?![A-Za-z0-9])"))


def _word_before(c: Column) -> Column:
    return F.lower(F.regexp_extract(c["before"], r"([A-Za-z]+)[^A-Za-z]{0,5}$", 1))


def _is(word: Column, words: str) -> Column:
    return word.rlike(f"^(?:{words})$")


def _for_against(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(c: Column, kind: str) -> list[Column]:
    """What each labeler of a kind says: 1 for, -1 against, 0 nothing."""
    match, before, word, size = c["match"], c["before"], _word_before(c), F.length(c["match"])
    if kind == "secret":
        share = _share(c, "[^0-9]")
        shape = match.rlike(
            "^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{16,}|[0-9A-F]{32,}|(?:sk|pk|rk|gh[opsu]|xox[abp])[-_].{8,}|eyJ.{20,}"
            "|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12})$"
        )
        votes = (
            _for_against(shape, size < 16),
            _for_against(_is(word, HINT_WORDS), _is(word, PLAIN_WORDS)),
            _for_against(before.rlike(r"[=:]\s?[\"']?$"), before.rlike(r"[/#?&.@-]$")),
            _for_against(share.between(0.15, 0.8), (share < 0.1) | (share > 0.9)),
            _for_against(_changes(c) >= 3, _changes(c) <= 1),
            _for_against(match.rlike("^[A-Za-z0-9]{20,}$"), _plain_parts(c) >= 2),
        )
    elif kind == "password":
        votes = (
            _for_against(_is(word, PHRASE_WORDS), _is(word, PLAIN_WORDS)),
            _for_against(before.rlike(r"=\s?[\"']?$|[\"']$"), before.rlike(r":\s{2}$")),
            _for_against(match.rlike("[0-9]") & match.rlike("[^0-9]"), match.rlike("^[a-z]+[.!?]?$")),
            _for_against(size >= 6, size < 5),
            _for_against(match.rlike(r"[^\w.]"), _is(F.lower(match), "none|null|true|false|your|this|that|required|optional")),
        )
    elif kind == "number":
        digits = _digits(c)
        shape = match.rlike(
            r"^(?:\([0-9]{3}\)[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}|(?:1[-.])?[0-9]{3}([-.\x20])[0-9]{3}\1[0-9]{4}"
            r"|[0-9]{3}[-\x20][0-9]{2}[-\x20][0-9]{4})$"
        )
        date = match.rlike(r"^(?:(?:1[0-9]|20)[0-9]{2}[-.][0-9]{2}[-.][0-9]{2}|[0-9]{1,2}[-.][0-9]{1,2}[-.][0-9]{4})$")
        votes = (
            _for_against(shape, date),
            _for_against(_is(word, NUMBER_WORDS), _is(word, PLAIN_WORDS)),
            _for_against(digits.between(9, 11), (digits < 7) | (digits > 12)),
            _for_against(match.rlike(r"^\(|^[0-9]+-[0-9]+-[0-9]+"), match.rlike(r"^[0-9]+\.[0-9]+$|^[0-9]+(?:\.[0-9]+){3,}$")),
            _for_against(before.rlike(r"[:#]\s?$"), c["after"].rlike("^[%/]") | before.rlike(r"[$%=*^/]\s?$")),
        )
    else:
        last = F.regexp_extract(match, r"([^\x20]+)$", 1)
        votes = (
            _for_against(before.rlike(rf"(?<!\p{{L}})(?:{TITLES})\.?\x20$"), before.rlike(r"(?:^|\s)(?i:the|in|at|of)\s$")),
            _for_against(match.rlike(rf"^(?:{GIVEN_NAMES})(?:\x20|$)"), match.rlike(r"^(?:The|This|That|It|He|She|I|In|On)(?:\x20|$)")),
            _for_against(match.rlike(r"\x20"), size < 3),
            _for_against(_is(word, f"{TITLES}|{NAME_WORDS}".lower()), _is(last, PLACE_WORDS)),
        )
    return [v.cast("string") for v in votes]


def _features(c: Column) -> list[Column]:
    match = c["match"]
    bucket = F.pmod(F.crc32(_word_before(c).cast("binary")), F.lit(WORDS_BEFORE))
    return [
        F.concat(F.lit("len="), F.least(F.floor(F.length(match) / 4), F.lit(16)).cast("string")),
        F.concat(F.lit("digit="), F.floor(_share(c, "[^0-9]") * 8).cast("string")),
        F.concat(F.lit("upper="), F.floor(_share(c, "[^A-Z]") * 8).cast("string")),
        F.concat(F.lit("turns="), F.least(_changes(c), F.lit(12)).cast("string")),
        F.concat(F.lit("words="), F.least(_plain_parts(c), F.lit(4)).cast("string")),
        F.concat(F.lit("word="), bucket.cast("string")),
        F.concat(F.lit("mark="), F.regexp_extract(c["before"], r"([=:\"'/#?&.@-])\s?$", 1)),
        F.concat(F.lit("hex="), match.rlike("^[0-9a-fA-F-]+$").cast("string")),
        F.concat(F.lit("first="), F.regexp_replace(F.regexp_replace(F.left(match, F.lit(1)), "[0-9]", "0"), r"\p{L}", "a")),
        F.concat(F.lit("groups="), F.least(F.size(F.split(match, r"[\x20.-]")), F.lit(6)).cast("string")),
    ]


@dataclass(frozen=True)
class Model:
    """For each kind how often its candidates are true, and each labeler's chance of each
    vote given the truth; the classifier's weights, the constant of a kind among them."""

    prior: dict[str, float]
    reliability: dict[str, tuple[tuple[dict[int, float], dict[int, float]], ...]]
    weights: dict[str, float]


def estimate(patterns: dict[str, float], rounds: int = 200) -> tuple[dict[str, float], float, tuple]:
    """The probability of each vote pattern being true, by expectation-maximisation."""
    rows = [(tuple(map(int, p.split(","))), p, n) for p, n in patterns.items()]
    width = len(rows[0][0])
    chance = {p: min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for v, p, _ in rows}
    for _ in range(rounds):
        total = sum(n for _, _, n in rows)
        yes = sum(chance[p] * n for _, p, n in rows)
        prior = (yes + 1) / (total + 2)
        tables = []
        for j in range(width):
            pair = []
            for truth in (0, 1):
                mass = {v: 0.5 for v in (-1, 0, 1)}
                for v, p, n in rows:
                    mass[v[j]] += n * (chance[p] if truth else 1 - chance[p])
                whole = sum(mass.values())
                pair.append({v: m / whole for v, m in mass.items()})
            tables.append(tuple(pair))
        moved = 0.0
        for v, p, _ in rows:
            odds = math.log(prior / (1 - prior)) + sum(
                math.log(tables[j][1][v[j]] / tables[j][0][v[j]]) for j in range(width)
            )
            new = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            moved, chance[p] = max(moved, abs(new - chance[p])), new
        if moved < 1e-9:
            break
    return chance, prior, tuple(tables)


def fit(docs: DataFrame) -> Model | None:
    """Learn from the candidates of all documents."""
    rows = docs.select(text_of().alias("_text"))
    rows = with_candidates(with_base(rows, "_text", "_base"), "_text", "_base", "_cand")
    each = rows.select(F.explode("_cand").alias("c")).select(
        "c.kind", "c.votes", F.explode(F.concat(F.array(F.lit("all")), "c.features")).alias("feature")
    )
    # per kind at most 3^6 vote patterns by about 150 features
    counted = [tuple(r) for r in each.groupBy("kind", "votes", "feature").count().collect()]
    if not counted:
        return None
    model = Model({}, {}, {})
    for kind in ADDED:
        own = sorted((v, f, float(n)) for k, v, f, n in counted if k == kind)
        if not own:
            continue
        chance, model.prior[kind], model.reliability[kind] = estimate({v: n for v, f, n in own if f == "all"})
        true: dict[str, float] = {}
        false: dict[str, float] = {}
        for votes, feature, n in own:
            true[feature] = true.get(feature, 0.0) + n * chance[votes]
            false[feature] = false.get(feature, 0.0) + n * (1 - chance[votes])
        yes, no = true.pop("all"), false.pop("all")
        model.weights[kind] = math.log((yes + 1) / (no + 1))
        for f in true:
            model.weights[f] = math.log((true[f] + 0.5) / (yes + 1)) - math.log((false[f] + 0.5) / (no + 1))
    return model


def with_spans(df: DataFrame, model: Model | None, text: str, base: str, name: str) -> DataFrame:
    """Add all spans: the fixed ones and the candidates that the classifier takes."""
    df = with_base(df, text, base)
    if model is None:
        return df.withColumn(name, F.col(base))
    candidates = unused(df, f"{name}_candidates")
    df = with_candidates(df, text, base, candidates)
    pairs = [F.lit(x) for item in sorted(model.weights.items()) for x in item]
    weights = F.create_map(*pairs)
    taken = F.filter(
        candidates,
        lambda c: F.aggregate(
            F.concat(F.array(c["kind"]), c["features"]), F.lit(0.0), lambda a, f: a + F.coalesce(F.element_at(weights, f), F.lit(0.0))
        )
        > 0,
    )
    ranks = F.create_map(*(F.lit(x) for i, k in enumerate(ADDED) for x in (k, len(KINDS) + i)))
    added = F.transform(
        taken,
        lambda c: F.struct(
            c["start"].alias("start"), F.element_at(ranks, c["kind"]).alias("rank"), c["end"].alias("end"), c["kind"].alias("kind")
        ),
    ).cast(_SPAN)
    return df.withColumn(name, F.array_sort(F.concat(F.col(base), added))).drop(candidates)


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, counts of the fixed kinds, and the spans of every row."""
    rows = with_spans(docs.select("doc_id", text_of().alias("_text")), model, "_text", "_base", "_spans")

    def number(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *map(number, KINDS),
        F.sha2(joined("_base"), 256).alias("base_sha256"),
        joined("_spans").alias("spans"),
        F.size("_spans").cast("long").alias("n_spans"),
    )


def redact(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows with every span of the text replaced by its kind in brackets; spans that
    overlap are replaced as one, named after the first."""
    text, base, spans = (unused(docs, n) for n in ("_text", "_base", "_spans"))
    rows = with_spans(docs.withColumn(text, text_of()), model, text, base, spans)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]
        gap = F.substring(F.col(text), state["at"] + 1, s["start"] - state["at"])
        grown = F.concat(state["out"], F.array(gap, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.when(inside, state["out"]).otherwise(grown).alias("out")
        )

    done = F.aggregate(
        spans, start, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(F.col(text), s["at"] + 1, F.length(text)))
    )
    out = F.when(F.size(spans) > 0, done).otherwise(F.col("text"))
    return rows.withColumn("text", out).select(*docs.columns)
