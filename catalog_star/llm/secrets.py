"""Secrets in texts: three named patterns, and runs of characters whose sliding-window Shannon entropy is high.

Everything is an expression over one row: no shuffle, no Python. A candidate is a longest run of one class's characters.
A window moves over it a character at a time; the counts of the character that enters and of the one that leaves
change, and with them the sum of ``n log2 n`` over the window's counts, from which its entropy follows. The sum is kept in whole numbers, so
it does not drift. Long candidates are walked in stretches that overlap by a window, so no step's state
grows with the text. Windows of high entropy that overlap or touch are one span. Candidates on the allow-list are passed over.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass
from math import floor, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns that are always reported.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

#: Candidates that are no secrets: words, paths and names of letters only, numbers, rules and fillers, alphabets in order, marked examples, UUIDs.
ALLOWED = (
    r"^[A-Za-z/_=+-]+$",
    r"^[0-9/_=+-]+$",
    "|".join(re.escape(c) + "{8}" for c in string.ascii_letters + string.digits + "+/=_-"),
    r"(?i)abcdefgh|01234567|12345678|example|placeholder|changeme|your[_-]?(?:api|key|token|secret)",
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
)

#: Bits after the binary point of ``n log2 n``.
SCALE = 20
#: Window starts walked with one state, and items of a running sum taken together.
STRETCH = 256


@dataclass(frozen=True)
class CharacterClass:
    """Characters of one class, a window's length and the least entropy, in bits a character, that marks it."""

    kind: str
    characters: str
    window: int
    least_bits: float

    @property
    def pattern(self) -> str:
        return f"[{self.characters}]{{{self.window},}}"

    @property
    def most_sum(self) -> int:
        """The largest sum of ``n log2 n``, scaled, of a window that is marked."""
        return floor(self.window * (log2(self.window) - self.least_bits) * 2**SCALE)

    def weights(self) -> list[int]:
        return [round(n * log2(n) * 2**SCALE) if n else 0 for n in range(self.window + 1)]


#: Random hexadecimal digits have about 3.5 bits in 24 characters, random base64 about 4.3; words of a language 3.3 to 3.7.
CLASSES = (CharacterClass("hex_entropy", "0-9A-Fa-f", 24, 3.0), CharacterClass("base64_entropy", "A-Za-z0-9+/=_-", 24, 4.0))


def running_sums(values: Column) -> Column:
    """The sum of the items before each item. Items are taken in groups, so the work is not quadratic."""
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / STRETCH).cast("int")), lambda k: F.slice(values, k * STRETCH + 1, STRETCH))
    zero = F.array(F.lit(0).cast("bigint"))
    total = lambda g: F.aggregate(g, F.lit(0).cast("bigint"), lambda a, x: a + x)
    before = F.aggregate(groups, zero, lambda a, g: F.concat(a, F.array(F.element_at(a, -1) + total(g))))
    inside = F.zip_with(groups, F.slice(before, 1, F.size(groups)), lambda g, b: F.slice(F.aggregate(g, F.array(b), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))), 1, F.size(g)))
    return F.when(F.size(values) > 0, F.flatten(inside)).otherwise(F.slice(zero, 1, 0))


def _lengths(strings: Column) -> Column:
    return F.transform(strings, lambda x: F.length(x).cast("bigint"))


def located(df: DataFrame, text: str, found: str, pattern: str, into: str) -> DataFrame:
    """Replace the matches in ``found`` by structs (start, match): what lies between the matches tells where they are."""
    any_found = F.size(found) > 0
    df = df.withColumn("__gaps", F.when(any_found, _lengths(F.split(text, pattern, -1))))
    df = df.withColumn("__steps", F.when(any_found, F.zip_with(F.slice("__gaps", 1, F.size(found)), _lengths(F.col(found)), lambda g, n: F.struct(g.alias("g"), n.alias("n")))))
    df = df.withColumn("__before", F.when(any_found, running_sums(F.transform("__steps", lambda s: s["g"] + s["n"]))))
    placed = F.zip_with(F.zip_with("__before", "__steps", lambda b, s: b + s["g"]), F.col(found), lambda start, match: F.struct(start.alias("start"), match.alias("match")))
    return df.withColumn(into, F.when(any_found, placed)).drop("__gaps", "__steps", "__before", found)


def _span(kind: int, start: Column, end: Column) -> Column:
    return F.struct(start.cast("bigint").alias("start"), F.lit(kind).alias("kind"), end.cast("bigint").alias("end"))


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")


def _joined(spans: Column, start: Column, end: Column) -> Column:
    """Spans in order with one more, whose start is not below theirs: it lengthens the last one if it overlaps or touches it."""
    last = F.element_at(spans, -1)
    one = lambda a, b: F.array(F.struct(a.cast("bigint").alias("start"), b.cast("bigint").alias("end")))
    merged = F.concat(F.slice(spans, 1, F.size(spans) - 1), one(last["start"], F.greatest(last["end"], end)))
    return F.when((F.size(spans) > 0) & (F.get(spans, F.size(spans) - 1)["end"] >= start), merged).otherwise(F.concat(spans, one(start, end)))


def entropy_spans(candidate: Column, kind: CharacterClass) -> Column:
    """Spans (start, end) of a candidate string, from 0, that windows of high entropy cover."""
    w, n = kind.window, F.length(candidate)
    weights = F.array(*[F.lit(x).cast("bigint") for x in kind.weights()])
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    start_state = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0).cast("bigint").alias("sum"), none.alias("spans"))

    def stretch(first: Column) -> Column:
        codes = F.transform(F.split(F.substring(candidate, first + 1, F.lit(STRETCH + w - 1)), ""), lambda c: F.ascii(c))
        paired = F.zip_with(codes, F.concat(F.array_repeat(F.lit(-1), w), codes), lambda c, d: F.struct(c.alias("enters"), d.alias("leaves")))
        steps = F.transform(F.filter(paired, lambda p: p["enters"].isNotNull()), lambda p, i: F.struct(i.alias("at"), p["enters"].alias("enters"), p["leaves"].alias("leaves")))

        def step(state: Column, s: Column) -> Column:
            change = lambda i: F.when(i == s["enters"], F.lit(1)).otherwise(F.lit(0)) - F.when(i == s["leaves"], F.lit(1)).otherwise(F.lit(0))
            came, went = F.get(state["counts"], s["enters"]), F.get(state["counts"], s["leaves"])
            weight = lambda x: F.get(weights, x)
            gain = weight(came + 1) - weight(came) + F.when(s["leaves"] >= 0, weight(went - 1) - weight(went)).otherwise(F.lit(0))
            total = state["sum"] + F.when(s["enters"] == s["leaves"], F.lit(0)).otherwise(gain)
            marked = (s["at"] >= w - 1) & (total <= kind.most_sum)
            return F.struct(
                F.transform(state["counts"], lambda x, i: x + change(i)).alias("counts"),
                total.alias("sum"),
                F.when(marked, _joined(state["spans"], s["at"] - (w - 1), s["at"] + 1)).otherwise(state["spans"]).alias("spans"),
            )

        return F.transform(F.aggregate(steps, start_state, step)["spans"], lambda x: F.struct((x["start"] + first).alias("start"), (x["end"] + first).alias("end")))

    firsts = F.transform(F.sequence(F.lit(0), F.floor((n - w) / STRETCH).cast("int")), lambda k: k * STRETCH)
    return F.aggregate(F.flatten(F.transform(firsts, stretch)), none, lambda spans, x: _joined(spans, x["start"], x["end"]))


def _marked(number: int, kind: CharacterClass):
    """What makes spans of a candidate (start, match)."""
    return lambda m: F.transform(entropy_spans(m["match"], kind), lambda x: _span(number, m["start"] + x["start"], m["start"] + x["end"]))


def find_secrets(
    docs: DataFrame, id: str = "doc_id", text: str = "text", classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED
) -> DataFrame:
    """A row per document: id, n_assign, n_access, n_hex and two arrays of (start, kind, end): ``base`` and ``spans``.

    Places are code points, ends exclusive; arrays rise by start, then kind (0 to 2 the named patterns, from 3 on ``classes``). ``base`` has
    what the named patterns find, leftmost first and without overlaps within a kind; ``spans`` has this and what the entropy adds. A null text is an
    empty one. Repeated rows and null ids are searched by themselves. Other columns are not read; an empty table gives an empty result.
    """
    # The names of the columns made here cannot clash: only the id and the text are taken over.
    df = docs.select(F.col(f"`{id}`").alias("__id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    patterns = {"__assign": ASSIGN, "__access": ACCESS, "__hex": HEX, **{f"__class{k}": c.pattern for k, c in enumerate(classes)}}
    df = df.withColumns({f"__found{name}": F.regexp_extract_all("__text", F.lit(pattern), F.lit(0)) for name, pattern in patterns.items()})
    for name, pattern in patterns.items():
        df = located(df, "__text", f"__found{name}", pattern, name)
    df = df.drop("__text")
    value = lambda m: F.length(F.regexp_extract(m["match"], ASSIGN, 2))
    whole = lambda kind: lambda m: _span(kind, m["start"], m["start"] + F.length(m["match"]))
    spans = {
        "__assign": F.transform(F.filter("__assign", lambda m: value(m) >= ASSIGN_VALUE), whole(0)),
        "__access": F.transform("__access", whole(1)),
        "__hex": F.transform("__hex", whole(2)),
    }
    for k, kind in enumerate(classes):
        clear = lambda m: ~m["match"].rlike("|".join(f"(?:{x})" for x in allowed)) if allowed else F.lit(True)
        spans[f"__class{k}"] = F.flatten(F.transform(F.filter(f"__class{k}", clear), _marked(3 + k, kind)))
    df = df.withColumns({name: F.coalesce(made, _no_spans()) for name, made in spans.items()})
    return df.select(
        F.col("__id").alias(id),
        *[F.size(f"__{name}").cast("bigint").alias(f"n_{name}") for name in ("assign", "access", "hex")],
        F.sort_array(F.concat("__assign", "__access", "__hex")).alias("base"),
        F.sort_array(F.concat(*patterns)).alias("spans"),
    )


def written(spans: Column, classes: tuple[CharacterClass, ...] = CLASSES) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(x) for x in ("assign", "access", "hex", *[c.kind for c in classes])])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def comparison_sql(documents: str, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> str:
    """DuckDB SQL for the digest columns of ``find_secrets``: every window's entropy is counted by itself."""
    quoted = lambda pattern: "'" + pattern.replace("'", "''") + "'"
    kinds = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), *[(c.kind, c.pattern) for c in classes]]
    matches = " UNION ALL ".join(
        f"SELECT r, {k} AS kind, regexp_extract_all(text, {quoted(p)}, 0) AS found, string_split_regex(text, {quoted(p)}) AS gaps FROM d" for k, (_, p) in enumerate(kinds)
    )
    windows = " UNION ALL ".join(
        f"""SELECT r, kind, start, {c.window} AS w, {c.most_sum} AS most, {c.weights()} AS weights, match,
        unnest(range(length(match) - {c.window - 1})) AS place FROM located WHERE kind = {3 + k}
        AND NOT regexp_matches(match, {quoted("|".join(f"(?:{x})" for x in allowed) or "a^")})"""
        for k, c in enumerate(classes)
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM {documents}),
m AS ({matches}),
n AS (SELECT r, kind, found, gaps, unnest(range(len(found))) AS i FROM m),
located AS (SELECT r, kind, found[i + 1] AS match,
  CAST(list_sum(list_transform(gaps[1:i + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i], lambda x: length(x))), 0) AS BIGINT) AS start FROM n),
windows AS ({windows}),
marked AS (SELECT r, kind, start, match, place, w FROM windows
  WHERE list_sum(list_transform(map_values(list_histogram(string_split(substr(match, place + 1, w), ''))), lambda x: weights[CAST(x + 1 AS BIGINT)])) <= most),
islands AS (SELECT *, sum(CASE WHEN place <= before + w THEN 0 ELSE 1 END) OVER (PARTITION BY r, kind, start ORDER BY place) AS island
  FROM (SELECT *, lag(place) OVER (PARTITION BY r, kind, start ORDER BY place) AS before FROM marked)),
spans AS (
  SELECT r, kind, start, start + length(match) AS stop FROM located
  WHERE kind IN (1, 2) OR kind = 0 AND length(regexp_extract(match, {quoted(ASSIGN)}, 2)) >= {ASSIGN_VALUE}
  UNION ALL SELECT r, kind, start + min(place), start + max(place) + any_value(w) FROM islands GROUP BY r, kind, start, island),
named AS (SELECT r, kind, start, {[name for name, _ in kinds]}[kind + 1] || ':' || start || ':' || stop AS span FROM spans),
texts AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans FROM named GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN texts USING (r)
"""
