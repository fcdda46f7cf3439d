"""Mixing sources to target weights, in DataFrame functions only.

The words of a source, its documents in hash order, are one stream, cut into blocks of fixed length. Each slot of the
mixture is drawn into an output shard, so the counts of a source over the shards are a multinomial draw with a
fixed total; within a source the slots, in shard order, map to blocks by a pseudorandom permutation for each pass over the source
(swap-or-not rounds, which permute any range in place of a sort). Blocks and slots are joined by index. The last
slot of a source is cut to the word, so a source gives its target exactly.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalog_star.llm.texts import WORD_PATTERN
from catalog_star.staging import stage

ROUNDS = 12
#: Hexadecimal digits of an MD5 digest that make a number.
DIGITS = 15


def hashed(*parts: Column | str) -> Column:
    """A number of 60 bits from the MD5 of the parts, which other engines compute alike."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, DIGITS), 16, 10).cast("long")


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """Where a pseudorandom permutation of 0 .. size - 1, chosen by the key, takes an index."""

    def round_(x: Column, r: Column) -> Column:
        pivot = F.pmod(hashed(F.lit("pivot"), *key, r.cast("string")), size)
        other = F.pmod(pivot - x, size)
        coin = hashed(F.lit("coin"), *key, r.cast("string"), F.greatest(x, other).cast("string"))
        return F.when(coin % 2 == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), index, round_)


@dataclass(frozen=True)
class Mixture:
    """``documents``: every row with its place in its source and the source's target. ``spans``: which words of which
    document fill which slot of which shard; ``source_rank`` and ``start`` name the document."""

    documents: DataFrame
    spans: DataFrame


def source_targets(sources: DataFrame, weights: tuple[float, ...], share: float, most_passes: int) -> DataFrame:
    """Add rank, weight and target to (source, source_size): what is above a cap is shared anew by weight until nothing is.

    The caps that bind are those of the sources with the least size for their weight. The table has a row per source,
    so ranking it in one task is what an index of sources costs.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("source_rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most_passes).withColumn("room", F.col("cap") / F.col("weight"))
    by_room = Window.orderBy("room", "source_rank")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    levelled = ranked.withColumn("__level", level)
    level = F.min(F.when(F.col("__level") <= F.col("room"), F.struct("room", "source_rank", "__level"))).over(everything)["__level"]
    return levelled.withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))).drop("__level", "room", "cap")


def mix_sources(
    docs: DataFrame,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most_passes: int = 2,
    block: int = 128,
    shard_slots: int = 4096,
    seed: str = "mix",
) -> Mixture:
    """Mix all documents so that sources meet their targets; sizes are words of whole texts.

    Sources in order of code points, null last, take the weights in turn and share ``share`` times all words, none more than
    ``most_passes`` times its own. No document is taken more often than that. A null or blank text has size 0 and is
    taken 0 times. Rows may repeat, ids be null: every row has a place of its own (equal rows are
    interchangeable). Other columns are not read; an empty table gives empty results. Reruns agree whatever the partitioning.
    """
    sized = stage(
        docs.select(
            F.col(f"`{id}`").alias("id"),
            F.col(f"`{source}`").cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col(f"`{text}`").cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(f"`{id}`", f"`{source}`", f"`{text}`").alias("key"),
        ),
        "sized",
    )
    count = sized.count()
    bits = max(0, math.ceil(math.log2(max(1, count) / max(2000, math.sqrt(count or 1)))))

    # where each document begins in its source: running sums within buckets of the hash order, then over buckets
    order = hashed(F.coalesce(F.col("id").cast("string"), F.lit("-")), F.col("size").cast("string"))
    dealt = sized.withColumn("order", order).withColumn("bucket", F.shiftrightunsigned("order", 4 * DIGITS - bits))
    within = Window.partitionBy("source", "bucket").orderBy("order", "id", "size", "key").rowsBetween(Window.unboundedPreceding, -1)
    buckets = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(over), F.lit(0)))
    sources = stage(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most_passes), "sources")
    begun = dealt.withColumn("__before", F.coalesce(F.sum("size").over(within), F.lit(0))).alias("d")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    begun = begun.join(buckets.alias("b"), same("d.source", "b.source") & (F.col("d.bucket") == F.col("b.bucket")))
    begun = begun.select("d.*", (F.col("bucket_start") + F.col("__before")).alias("start")).alias("d").join(sources.alias("s"), same("d.source", "s.source"))
    documents = stage(begun.select("id", "d.source", "size", "key", "source_rank", "start", "source_size", "weight", "target"), "placed")

    # slots of each source: whole passes, then part of one
    full = F.floor(F.col("source_size") / block)
    passes = sources.where("source_size > 0").select(
        "source_rank",
        full.alias("full"),
        (F.col("source_size") - full * block).alias("tail"),
        F.floor(F.col("target") + 0.5).cast("long").alias("want"),
        "source_size",
    )
    passes = passes.withColumn("per_pass", F.col("full") + (F.col("tail") > 0).cast("long"))
    passes = passes.withColumn("whole", F.expr("want div source_size")).withColumn("rest", F.expr("want % source_size"))
    passes = passes.withColumn("slots", F.col("whole") * F.col("per_pass") + F.ceil(F.col("rest") / block)).where("slots > 0")
    total = passes.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // shard_slots))
    tasks = max(1, min(10_000, total // 20_000))

    # multinomial counts of each source per shard: every slot is drawn into one
    step = 10_000
    begin = F.explode(F.sequence(F.lit(0), F.col("slots") - 1, F.lit(step)))
    chunks = passes.select("source_rank", "slots", begin.alias("begin")).repartition(tasks, "source_rank", "begin")
    drawn = chunks.select("source_rank", F.explode(F.sequence("begin", F.least(F.col("begin") + step, "slots") - 1)).alias("draw"))
    shard = F.pmod(hashed(F.lit(seed), F.lit("shard"), F.col("source_rank").cast("string"), F.col("draw").cast("string")), F.lit(shards))
    counts = drawn.groupBy("source_rank", shard.alias("shard")).agg(F.count("*").alias("n"))
    along = Window.partitionBy("source_rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("n").over(along), F.lit(0)))

    # slots to blocks
    slots = counts.repartition(tasks, "source_rank", "shard").select("source_rank", "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("slot"))
    slots = slots.join(passes, "source_rank").withColumn("pass", F.expr("slot div per_pass")).withColumn("place", F.expr("slot % per_pass"))
    moved = permuted(F.col("place"), F.col("full"), F.lit(seed), F.col("source_rank").cast("string"), F.col("pass").cast("string"))
    slots = slots.withColumn("block", F.when(F.col("place") < F.col("full"), moved).otherwise(F.col("full")))
    length = F.when(F.col("place") < F.col("full"), F.lit(block)).otherwise(F.col("tail"))
    length = F.when(F.col("pass") == F.col("whole"), F.least(length, F.col("rest") - F.col("place") * block)).otherwise(length)
    slots = slots.select("source_rank", "shard", "slot", "pass", "block", length.cast("long").alias("length"))

    # documents to blocks
    pieces = documents.where("size > 0").select(
        "source_rank", "start", "size", "id", "key",
        F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block"),
    )
    at = F.col("block") * block
    low = F.greatest(F.col("start"), at)
    high = F.least(F.col("start") + F.col("size"), at + F.col("length"))
    # Slots are exploded from a table of one row per source, by whose size Spark would take them for small and send all of them through the driver.
    spans = slots.join(pieces.hint("merge"), ["source_rank", "block"]).where(high > low)
    spans = spans.select("shard", "source_rank", "slot", "pass", "id", "key", "start", (low - F.col("start")).alias("from_word"), (high - low).alias("words"))
    return Mixture(documents, spans)


def taken_words(mixture: Mixture) -> DataFrame:
    """Every row with the words that the mixture takes of it, repeats counted."""
    taken = mixture.spans.groupBy("source_rank", "start").agg(F.sum("words").alias("taken"))
    held, empty = mixture.documents.where("size > 0"), mixture.documents.where("size = 0")
    found = held.join(taken, ["source_rank", "start"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    return found.unionByName(empty.withColumn("taken", F.lit(0).cast("long")))


def mixed_texts(docs: DataFrame, mixture: Mixture, id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of ``docs`` as the mixture takes them: a row per document and pass, its text the taken runs of words in order.

    All columns stay, whatever their names but those that begin with two underscores. Words keep the white space that follows them. Rows equal in id, source and text are one document here, with all their spans.
    """
    key = F.xxhash64(f"`{id}`", f"`{source}`", f"`{text}`")
    runs = mixture.spans.groupBy(F.col("key").alias("__mix_key"), F.col("pass").alias("__mix_pass")).agg(F.sort_array(F.collect_list(F.struct("from_word", "words"))).alias("__runs"))
    one = docs.withColumn("__key", key).dropDuplicates(["__key"])
    words = F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(WORD_PATTERN + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.concat_ws("", F.transform("__runs", lambda r: F.concat_ws("", F.slice("__words", (r["from_word"] + 1).cast("int"), r["words"].cast("int")))))
    return one.withColumn("__words", words).join(runs, F.col("__key") == F.col("__mix_key")).withColumn(text, cut).drop("__words", "__runs", "__key", "__mix_key", "__mix_pass")


def comparison_sql(table: str, weights=(5, 2, 1), share=1.5, most_passes=2, block=128, seed="mix") -> str:
    """The words taken of each document, as DuckDB SQL. Shards have no influence on them."""

    def number(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, {DIGITS}) AS BIGINT)"

    rounds = "SELECT *, place AS x0 FROM slots WHERE place < full_blocks"
    for r in range(ROUNDS):
        key = f"'{seed}|' || source_rank || '|' || pass || '|{r}'"
        rounds = f"""SELECT *, CASE WHEN {number(f"'coin|' || {key} || '|' || greatest(x{r}, o{r})")} % 2 = 1 THEN o{r} ELSE x{r} END AS x{r + 1}
          FROM (SELECT *, ((p{r} - x{r}) % full_blocks + full_blocks) % full_blocks AS o{r}
          FROM (SELECT *, {number(f"'pivot|' || {key}")} % full_blocks AS p{r} FROM ({rounds})))"""
    choice = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD_PATTERN}')), 0) AS BIGINT) AS size FROM {table}),
placed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY {number("coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || size")}, doc_id, size
    ROWS UNBOUNDED PRECEDING) - size AS start FROM sized),
ranked AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank FROM sized GROUP BY source),
weighed AS (SELECT *, CAST(CASE source_rank % {len(weights)} {choice} END AS DOUBLE) AS weight FROM ranked),
levels AS (SELECT *, source_size * {most_passes} / weight AS room,
    (sum(source_size) OVER () * CAST({share} AS DOUBLE) - coalesce(sum(source_size * {most_passes}) OVER (ORDER BY source_size * {most_passes} / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY source_size * {most_passes} / weight, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (SELECT *, least(CAST(source_size * {most_passes} AS DOUBLE),
    coalesce((SELECT level FROM levels WHERE level <= room ORDER BY room, source_rank LIMIT 1), 0) * weight) AS target FROM levels),
passes AS (SELECT *, source_size // {block} AS full_blocks, source_size % {block} AS tail, CAST(floor(target + 0.5) AS BIGINT) AS want FROM targets WHERE source_size > 0),
planned AS (SELECT *, full_blocks + CAST(tail > 0 AS BIGINT) AS per_pass, want // source_size AS whole, want % source_size AS rest FROM passes),
slots AS (SELECT *, slot // per_pass AS pass, slot % per_pass AS place
    FROM (SELECT *, unnest(range(whole * per_pass + (rest + {block - 1}) // {block})) AS slot FROM planned)),
moved AS (SELECT source_rank, pass, place, whole, rest, tail, full_blocks, x{ROUNDS} AS block FROM ({rounds})
    UNION ALL SELECT source_rank, pass, place, whole, rest, tail, full_blocks, full_blocks FROM slots WHERE place >= full_blocks),
cut AS (SELECT source_rank, block, CASE WHEN pass = whole THEN least(l, rest - place * {block}) ELSE l END AS length
    FROM (SELECT *, CASE WHEN place < full_blocks THEN {block} ELSE tail END AS l FROM moved)),
docs AS (SELECT p.doc_id, p.size, p.start, t.source_rank, t.source_size, t.target FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source),
pieces AS (SELECT *, unnest(range(CAST(start // {block} AS BIGINT), CAST((start + size - 1) // {block} + 1 AS BIGINT))) AS block FROM docs WHERE size > 0),
spans AS (SELECT source_rank, start, sum(greatest(0, least(start + size, block * {block} + length) - greatest(start, block * {block}))) AS taken
    FROM pieces JOIN cut USING (source_rank, block) GROUP BY ALL)
SELECT d.doc_id, d.size, d.source_size, d.target, CAST(CASE WHEN d.size > 0 THEN coalesce(s.taken, 0) ELSE 0 END AS BIGINT) AS taken
FROM docs d LEFT JOIN spans s USING (source_rank, start)
"""
