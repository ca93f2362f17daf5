"""Personal data by candidate gradient boosting, in DataFrame functions only.

High-recall generators propose spans (they may overlap): loose numbers, loose
addresses, assignments to credential names, tokens that mix letters and digits.
Boosted trees score each candidate from format and context features; they run
as CASE expressions inside the row.  Calibrated thresholds select the spans
that are added to the base spans (email, ip, card, phone), which always stay.

Training: all candidates of all documents, whose base phones and emails are
masked (no '+', no dots in the domain), so that the generators find them but the
base patterns do not.  Candidates of equal features are alike, so Spark counts
them, and the trees are grown from the counts.  Like the spans that are added, all
candidates learned from lie outside base spans.  Positive are those on a masked
span, assignments to credential names, and tokens that stand in one or have a
strict credential form.  ``DECOYS`` written texts add look-alikes that are no
personal data (dates, order numbers, digests, '@' without a domain, credential
names in prose), so every generator has negatives whatever the documents hold,
and as many written assignments show values of other forms than the documents'.
Where a generator has more than ``BALANCE`` candidates in the documents, its
written ones count for more in proportion, so that their share does not fade.
One half of all this grows the trees, the other sets each generator's threshold:
the smallest score whose precision on it is ``PRECISION`` (no threshold: nothing
is added).

Positions are code points, end exclusive.  Matches are found by ``split`` and
``regexp_extract_all`` with one pattern, so starts are running sums of lengths.
The patterns take each run of characters once (possessive quantifiers, no
restart inside a run), and matches are summed in blocks of ``BLOCK`` whose starts
are known beforehand, so no array of all matches is copied once per match.

Defined cases: a null text is empty and has no spans (counts 0, digest of the
empty string); empty tables give no rows; repeated rows are scored alike; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .gbt import Trees, fit

BALANCE = 5_000
DECOYS = 400
PRECISION = 0.99
BLOCK = 32

# Base kinds, in the order in which spans are listed.  \G admits a
# match right behind the one before it; the look-behind forbids a start inside
# a run that was tried from its beginning.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# a cheap test that must hold where the pattern matches
GATES = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}

# Candidate generators.  No run has an upper length; it is a feature.
GENERATORS = (
    ("secret", r"(?i)(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}"
               r"[\"']?[^\s\"',;]{6,}+[\"']?", r"[:=]"),
    ("secret", r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])[A-Za-z0-9]{12,}+", r"[0-9]"),
    ("phone", r"(?<![0-9(+])[+(]?[0-9][0-9() .-]{5,}[0-9]", r"[0-9]"),
    ("email", r"(?<![^\s@])[^\s@]++@[^\s@]++", r"@"),
)
STRICT = r"^AKIA[0-9A-Z]{16}$"
ASSIGNMENT, TOKEN = 0, 1          # places in GENERATORS
ALL_KINDS = (*KINDS, "secret")
CONTEXT = 24


MATCH = "struct<v:string,s:int,e:int,b:string>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _blocked(array: Column) -> Column:
    """An array in pieces of ``BLOCK`` elements."""
    def cut(items):
        last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
        pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(items) > 0, pieces).otherwise(F.slice(F.array(items), 1, 0))
    return _let(array, cut)


def _running(values: Column, combine) -> Column:
    """array<int> of what ``combine`` makes of all values before each one (from 0)."""
    return F.aggregate(values, F.array(F.lit(0)), lambda acc, v: F.concat(acc, F.array(combine(F.element_at(acc, -1), v))))


def _folded(blocks: Column, start, kind: str, step, enter=None) -> Column:
    """array<kind> of what ``step(state, item, told) -> (state, value)`` gives for
    each item in turn.  ``start(block, i)``: the state before a block; ``told``:
    what ``enter(state, block)`` says of it.  Aggregates copy their state at every
    step, so no state holds more than one block's values."""
    none = F.array().cast(f"array<{kind}>")

    def one_block(block, i):
        def fold(told, state):
            def merge(inner, item):
                after, value = step(inner["st"], item, told)
                return F.struct(after.alias("st"), F.concat(inner["out"], F.array(value)).alias("out"))
            return F.aggregate(block, F.struct(state.alias("st"), none.alias("out")), merge, lambda done: done["out"])
        return _let(start(block, i), lambda state: _let(enter(state, block), lambda told: fold(told, state)) if enter else fold(None, state))

    return F.flatten(F.transform(blocks, one_block))


def _matches(text: Column, pattern: str, gate: str) -> Column:
    """array<struct<v, s, e, b>> of the leftmost non-overlapping matches; ``b``:
    the ``CONTEXT`` characters before."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.filter(F.arrays_zip(hits.alias("v"), gaps.alias("g")), lambda p: p["v"].isNotNull())

    def step(st, p, _):
        start = st["at"] + F.length(p["g"])
        end = start + F.length(p["v"])
        before = F.substring(F.concat(st["tail"], p["g"]), -CONTEXT, CONTEXT)
        after = F.struct(end.alias("at"), F.substring(F.concat(before, p["v"]), -CONTEXT, CONTEXT).alias("tail"))
        return after, F.struct(p["v"].alias("v"), start.alias("s"), end.alias("e"), before.alias("b"))

    def in_blocks(all_pairs):
        blocks = _blocked(all_pairs)
        sizes = F.transform(blocks, lambda block: F.aggregate(
            block, F.lit(0), lambda n, p: n + F.length(p["g"]) + F.length(p["v"])))

        def tail(i):
            # a pair has a character at least
            first = F.greatest(i * BLOCK - CONTEXT, F.lit(0))
            last = F.transform(F.slice(all_pairs, first + 1, i * BLOCK - first), lambda p: F.concat(p["g"], p["v"]))
            return F.substring(F.array_join(last, ""), -CONTEXT, CONTEXT)

        return _let(_running(sizes, lambda n, m: n + m), lambda at: _folded(
            blocks, lambda _, i: F.struct(F.get(at, i).alias("at"), tail(i).alias("tail")), MATCH, step))

    found = _let(pairs, in_blocks)
    return F.when(text.rlike(gate), found).otherwise(F.array().cast(f"array<{MATCH}>"))


def _ranges(spans: Column) -> Column:
    """Spans in blocks of blocks, each with the range that it lies in, for ``_overlaps``."""
    def over(items: Column) -> Column:
        return F.transform(_blocked(items), lambda g: F.struct(
            F.array_min(F.transform(g, lambda b: b["s"])).alias("s"), F.array_max(F.transform(g, lambda b: b["e"])).alias("e"),
            g.alias("within")))
    return over(over(F.transform(spans, lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e")))))


def _overlaps(ranges, c: Column, depth: int = 2) -> Column:
    def meets(b):
        here = (b["s"] < c["e"]) & (c["s"] < b["e"])
        return here & _overlaps(b["within"], c, depth - 1) if depth else here
    return F.exists(ranges, meets)


def luhn(digits: Column) -> Column:
    """The check digit holds (digits: a string of 0-9, not empty)."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return v.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = F.translate(v, " -", "")
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.translate(v, "+ ().-", "")).between(9, 15)
    return F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_t`` (the text, null as empty) and ``_base``:
    array<struct<kind, s, e>> of base spans by kind as listed, then start."""
    out = docs.withColumn("_t", F.coalesce(F.col("text"), F.lit("")))
    out = out.withColumns({f"_{k}": _matches(F.col("_t"), PATTERNS[k], GATES[k]) for k in KINDS})

    def valid_of(kind: str) -> Column:
        return F.transform(F.filter(F.col(f"_{kind}"), lambda m: _valid(kind, m["v"])),
                           lambda m: F.struct(F.lit(kind).alias("kind"), m["s"].alias("s"), m["e"].alias("e")))

    return out.withColumn("_base", F.concat(*[valid_of(k) for k in KINDS])).drop(*[f"_{k}" for k in KINDS])


def _count(v: Column, chars: str) -> Column:
    return F.length(v) - F.length(F.translate(v, chars, ""))


FEATURES = ("generator", "length", "digits", "upper", "symbols", "at", "dots", "plus", "checks", "name_before",
            "contact_before", "equals", "distinct", "digit_share", "spaces")


def _features(generator: int, v: Column, before: Column) -> list[Column]:
    digits = _count(v, "0123456789")
    plain = F.regexp_replace(v, "[^0-9]", "")
    return [c.cast("double") for c in (
        F.lit(generator), F.length(v), digits, F.length(F.regexp_replace(v, "[^A-Z]", "")),
        F.length(F.regexp_replace(v, "[A-Za-z0-9]", "")), _count(v, "@"), _count(v, "."), _count(v, "+"),
        F.when(F.length(plain).between(13, 19), luhn(plain)).otherwise(F.lit(False)).cast("int"),
        before.rlike(r"(?:password|passwd|pwd|secret|token|key)\W*$").cast("int"),
        before.rlike(r"(?:tel|phone|call|fax|mail|contact)\W*$").cast("int"), _count(v, "="),
        F.size(F.array_distinct(F.split(v, ""))), digits / F.length(v), _count(v, " "))]


def candidates(df: DataFrame) -> DataFrame:
    """Adds ``_cand``: array<struct<kind, s, e, v, x: array<double>>> of the
    proposed spans that lie outside all base spans or overlap them (``hit``)."""
    t = F.col("_t")
    out = df.withColumns({f"_g{i}": _matches(t, p, gate) for i, (_, p, gate) in enumerate(GENERATORS)})
    out = out.withColumn("_ranges", _ranges(F.col("_base")))

    def described(i: int, kind: str) -> Column:
        def describe(m):
            return F.struct(F.lit(kind).alias("kind"), m["s"].alias("s"), m["e"].alias("e"), m["v"].alias("v"),
                            _overlaps("_ranges", m).alias("hit"), F.array(*_features(i, m["v"], F.lower(m["b"]))).alias("x"))
        return F.transform(F.col(f"_g{i}"), describe)

    arrays = [described(i, kind) for i, (kind, _, _) in enumerate(GENERATORS)]
    return out.withColumn("_cand", F.concat(*arrays)).drop("_ranges", *[f"_g{i}" for i in range(len(GENERATORS))])


def _tree_column(x: Column, model: Trees, i: int, node: int = 0) -> Column:
    inner = 2**model.depth - 1
    if node >= inner:
        return F.lit(float(model.value[i][node - inner]))
    limit = float(model.threshold[i][node])
    left = _tree_column(x, model, i, 2 * node + 1)
    if np.isinf(limit):
        return left
    return F.when(x[int(model.feature[i][node])] > limit, _tree_column(x, model, i, 2 * node + 2)).otherwise(left)


def margin_column(x: Column, model: Trees) -> Column:
    total = F.lit(model.bias)
    for i in range(len(model.value)):
        total = total + _tree_column(x, model, i)
    return total


def masked(text: Column) -> Column:
    """``text`` of the same length without the signs that make a base phone or
    email: '+' before a digit, dots in the domain."""
    out = F.regexp_replace(text, r"\+(?=[0-9])", " ")
    return F.regexp_replace(out, r"(?:(@[A-Za-z0-9-]++)|\G(?!^)([A-Za-z0-9-]++))\.(?=[A-Za-z0-9-])", "$1$2-")


def training_rows(docs: DataFrame) -> DataFrame:
    """(fold, x, y) of the candidates outside base spans in masked documents."""
    told = base_spans(docs.select("doc_id", "text")).select(
        "doc_id", masked(F.col("_t")).alias("text"), F.filter("_base", lambda b: b["kind"].isin("phone", "email")).alias("_told"))
    given = candidates(base_spans(told)).withColumns({
        "_told": _ranges(F.col("_told")), "_given": _ranges(F.filter("_cand", lambda c: c["x"][0] == ASSIGNMENT))})
    rows = F.transform(F.filter("_cand", lambda c: ~c["hit"]), lambda c: F.struct(
        c["x"].alias("x"), _overlaps("_told", c).alias("told"), _overlaps("_given", c).alias("given"),
        c["v"].rlike(STRICT).alias("strict")))
    generator = F.col("c.x")[0]
    # loose numbers and addresses inside an assignment tell nothing of either kind
    # explode would filter on the size of the candidates, and so find them twice
    return given.select("doc_id", F.explode_outer(rows).alias("c")).where(F.col("c").isNotNull()).where(
        generator.isin(ASSIGNMENT, TOKEN) | F.col("c.told") | ~F.col("c.given")).select(
        F.pmod(F.xxhash64("doc_id", F.lit("pii fold")), F.lit(2)).alias("fold"), F.col("c.x").alias("x"),
        (F.col("c.told") | generator.isin(ASSIGNMENT, TOKEN) & (F.col("c.given") | F.col("c.strict"))).alias("y"))


def decoy_texts(spark: SparkSession, n: int = DECOYS) -> DataFrame:
    """(doc_id, text) of ``n`` written texts full of look-alikes that are no
    personal data; digits and letters come from hashes of the id."""
    i = F.col("id")

    def number(salt: str, low: int, high: int) -> Column:
        return (F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(high - low + 1)) + low).cast("string")

    def digits(salt: str, size: int) -> Column:
        return F.lpad(number(salt, 0, 10**size - 1), size, "0")

    def hexes(salt: str, size: int) -> Column:
        return F.substring(F.sha2(F.concat(i.cast("string"), F.lit(salt)), 256), 1, size)

    def word(salt: str) -> Column:
        kinds = ("required", "optional", "forgotten", "unchanged", "encrypted", "ingredient", "holders", "settings",
                 "management", "recovery", "expired-today", "case-sensitive")
        return F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(len(kinds))) + 1).cast("int"))

    name = F.element_at(F.array(*[F.lit(k) for k in ("password", "passwd", "pwd", "secret", "token", "api_key")]),
                        (F.pmod(F.xxhash64(i, F.lit("name")), F.lit(6)) + 1).cast("int"))
    day = (digits("y", 2), F.lpad(number("m", 1, 12), 2, "0"), F.lpad(number("d", 1, 28), 2, "0"))
    parts = (
        # credential names in prose
        "Note on the", name, F.lit(": "), word("w"), "and its", name, F.lit(" = "), word("v"), "as told.",
        # digests, codes, joined words
        "See commit", hexes("c", 40), "of file", hexes("f", 32), "and sum", hexes("s", 64), "in part",
        F.concat(F.lit("chapter"), number("c1", 1, 30), F.lit("section"), number("c2", 1, 90)), "of model",
        F.concat(F.lit("XR"), digits("x", 6), F.lit("REV"), digits("r", 3)), "with order", digits("o", 14), "or",
        # numbers
        "on", F.concat(F.lit("20"), day[0], F.lit("-"), day[1], F.lit("-"), day[2]), "and",
        F.concat(day[2], F.lit("."), day[1], F.lit(".19"), day[0]), "in the years",
        F.concat(F.lit("19"), digits("a", 2), F.lit("-20"), digits("b", 2)), "about",
        F.concat(number("n", 1, 99), F.lit(" "), digits("n1", 3), F.lit(" "), digits("n2", 3)), "pieces at",
        F.concat(number("p", 1, 999), F.lit("."), digits("p1", 6)), "each, item", number("q", 10**6, 10**9), "and book",
        F.concat(F.lit("978-"), number("i1", 1, 9), F.lit("-"), digits("i2", 3), F.lit("-"), digits("i3", 5), F.lit("-"), number("i4", 0, 9)),
        "of table", F.concat_ws(" ", *[number(f"t{k}", 1, 99) for k in range(5)]), "then",
        # '@' without a domain
        F.concat(number("e", 1, 99), F.lit("@"), number("e1", 1, 999)), "units,", F.concat(word("h"), F.lit("@"), word("g")), "or",
        F.concat(F.lit("v"), number("z", 1, 9), F.lit("@"), hexes("z", 8)), "at last")
    text = F.concat_ws(" ", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return spark.range(n).select(i.alias("doc_id"), F.regexp_replace(text, r" +(:|=) +", "$1 ").alias("text"))


def written_secrets(spark: SparkSession, n: int = DECOYS) -> DataFrame:
    """(doc_id, text) of ``n`` written assignments: words with numbers, mixed
    characters, hexadecimal digits."""
    i = F.col("id")

    def some(salt: str, kinds: tuple[str, ...]) -> Column:
        return F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(len(kinds))) + 1).cast("int"))

    words = ("Zebra", "horse", "Blue", "river", "cloud", "Tiger", "paper", "Stone", "apple", "Night")
    digest = F.sha2(i.cast("string"), 256)
    number = F.pmod(F.xxhash64(i, F.lit("number")), F.lit(10_000)).cast("string")
    values = F.array(
        F.concat(some("a", words), some("sep", ("-", "_", ".", "")), some("b", words), some("sep", ("-", "_", ".", "")), number),
        F.concat(some("a", words), number, some("end", ("!", "#", "x", "xyz"))),
        F.substring(F.base64(F.unhex(digest)), F.lit(1), (F.pmod(F.xxhash64(i, F.lit("n")), F.lit(30)) + 12).cast("int")),
        F.substring(digest, F.lit(1), (F.pmod(F.xxhash64(i, F.lit("h")), F.lit(5)) * 8 + 8).cast("int")))
    text = F.concat(F.lit("set the "), some("name", ("password", "passwd", "pwd", "secret", "token", "api_key", "api-key")),
                    some("is", ("=", ": ", " = ", ":")), F.element_at(values, (i % 4 + 1).cast("int")), F.lit(" there"))
    return spark.range(n).select(i.alias("doc_id"), text.alias("text"))


def written_rows(spark: SparkSession, n: int = DECOYS) -> DataFrame:
    """(fold, x, y) of the candidates in written texts: all of ``decoy_texts``
    negative, the assignments of ``written_secrets`` positive."""
    texts = decoy_texts(spark, n).withColumn("y", F.lit(False)).unionByName(written_secrets(spark, n).withColumn("y", F.lit(True)))
    found = candidates(base_spans(texts))
    return found.select("doc_id", "y", F.explode(F.filter("_cand", lambda c: ~c["hit"])).alias("c")).where(
        ~F.col("y") | (F.col("c.x")[0] == ASSIGNMENT)).select(
        F.pmod(F.xxhash64("doc_id", F.lit("pii fold")), F.lit(2)).alias("fold"), F.col("c.x").alias("x"), "y")


def thresholds(score: np.ndarray, truth: np.ndarray, generator: np.ndarray, times: np.ndarray | None = None) -> list[float]:
    """The smallest score of each generator whose precision is ``PRECISION``;
    ``times``: how many candidates each one stands for."""
    times = np.ones(len(score)) if times is None else times
    out = []
    for g in range(len(GENERATORS)):
        mine = generator == g
        s, y, n = score[mine], truth[mine], times[mine]
        order = np.argsort(-s, kind="stable")
        s, y, n = s[order], y[order], n[order]
        last = np.append(s[1:] != s[:-1], True) if len(s) else np.zeros(0, bool)      # equal scores go together
        good = np.flatnonzero(last & (np.cumsum(y * n) >= PRECISION * np.cumsum(n)))
        out.append(max(float(s[good[-1]]), 0.0) if len(good) else float("inf"))
    return out


def counted_rows(rows: DataFrame) -> np.ndarray:
    """A row (fold, features, y, times) for each distinct row of (fold, x, y), in a fixed order."""
    found = rows.groupBy("fold", "x", "y").agg(F.count(F.lit(1)).alias("n")).collect()
    found = sorted((r["fold"], *r["x"], r["y"], r["n"]) for r in found)
    return np.array(found, dtype=float).reshape(len(found), len(FEATURES) + 3)


def train(docs: DataFrame, decoys: int = DECOYS) -> tuple[Trees, list[float]]:
    """(trees, threshold on the margin of each generator) from all ``docs`` and
    ``decoys`` written texts of each sort."""
    table = counted_rows(training_rows(docs.select("doc_id", "text")))
    if decoys:
        total = np.bincount(table[:, 1].astype(int), table[:, -1], len(GENERATORS))
        written = counted_rows(written_rows(docs.sparkSession, decoys))
        written[:, -1] *= np.ceil(np.maximum(total / BALANCE, 1.0))[written[:, 1].astype(int)]
        table = np.vstack([table, written])
    x, y, times, first = table[:, 1:-2], table[:, -2], table[:, -1], table[:, 0] == 0
    model = fit(x[first], y[first], trees=24, depth=3, rate=0.3, bins=48, least_rows=3, times=times[first])
    # with one class only the model has no trees, and all scores are its bias
    return model, thresholds(model.margin(x[~first]), y[~first], x[~first, 0], times[~first])


def find(docs: DataFrame, model: Trees, least: list[float]) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans`` (base and added spans)."""
    df = base_spans(docs)
    if np.isinf(least).all():
        return df.withColumn("_spans", F.col("_base"))
    df = candidates(df)
    added = F.filter("_cand", lambda c: ~c["hit"] & (margin_column(c["x"], model) >= F.element_at(
        F.array(*[F.lit(v) for v in least]), c["x"][0].cast("int") + 1)))
    added = F.transform(added, lambda c: F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e")))
    order = F.create_map(*[F.lit(v) for pair in ((k, i) for i, k in enumerate(ALL_KINDS)) for v in pair])
    ranked = F.transform(F.concat("_base", F.array_distinct(added)), lambda s: F.struct(
        order[s["kind"]].alias("o"), s["s"].alias("s"), s["e"].alias("e"), s["kind"].alias("kind")))
    both = F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"].alias("kind"), s["s"].alias("s"), s["e"].alias("e")))
    return df.withColumn("_spans", both).drop("_cand")


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["s"].cast("string"),
                                                                  s["e"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """Span counts, digest of the base spans and all spans of each document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = find(narrow, *train(narrow))

    def count(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS],
                        F.sha2(_joined("_base"), 256).alias("base_sha256"), _joined("_spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets
    (overlapping spans by one mark); ``n_chars``, where present, is recounted.
    A null text stays null."""
    # the row travels whole, so its columns cannot meet those made here
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    found = find(whole, *train(docs))
    ordered = F.array_sort(F.transform("_spans", lambda s: F.struct(s["s"].alias("s"), s["e"].alias("e"), s["kind"].alias("kind"))))
    t = F.col("_t")

    def enter(at, block):
        # the text of a block of spans is taken out once
        stop = F.greatest(at, F.array_max(F.transform(block, lambda s: s["e"])))
        return F.struct(at.alias("at"), F.substring(t, at + 1, stop - at).alias("text"))

    def step(at, s, told):
        piece = F.concat(F.substring(told["text"], at - told["at"] + 1, s["s"] - at), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.greatest(at, s["e"]), F.when(s["s"] >= at, piece).otherwise(F.lit(""))

    def in_blocks(spans):
        blocks = _blocked(spans)
        ends = F.transform(blocks, lambda block: F.array_max(F.transform(block, lambda s: s["e"])))
        return F.array_join(_let(_running(ends, F.greatest), lambda at: _folded(
            blocks, lambda _, i: F.get(at, i), "string", step, enter)), "")

    marked = _let(ordered, in_blocks)
    rest = F.substring(t, F.array_max(F.transform("_spans", lambda s: s["e"])) + 1, F.length(t))
    pieces = F.concat(marked, rest)
    text = F.when(F.col("text").isNull(), F.lit(None)).when(F.size("_spans") == 0, t).otherwise(pieces)
    out = {c: F.col("_row").getField(c) for c in docs.columns}
    out["text"] = text.cast("string")
    if "n_chars" in out:
        out["n_chars"] = F.when(F.size("_spans") == 0, out["n_chars"]).otherwise(
            F.length(out["text"]).cast(docs.schema["n_chars"].dataType))
    return found.select(*[v.alias(c) for c, v in out.items()])
