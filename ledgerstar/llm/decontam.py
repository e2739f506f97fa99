"""Benchmark decontamination as a prefix-filtered set join.

An item's text is cut into windows of WINDOW consecutive words; a document is
contaminated where it contains a window exactly. A window is the set of its
positioned shingles of SHINGLE words, and since it must be contained whole,
one shingle is enough of a prefix: the one that is rarest in the corpus.

1. All shingles of all documents meet the benchmark's distinct shingles once;
   the matches (document, position, shingle) are written. Their numbers per
   shingle give the order of rarity.
2. Each window's rarest shingle is joined to the matches. The position of the
   match sets where the window would lie; windows that would start before the
   text or end behind it are dropped.
3. What is left is verified: every other shingle of the window must have
   matched at its own place. Shingles are compared by their words, so a
   verified window equals the words of the document.

DataFrame operations only. The benchmark's shingles are broadcast if there
are at most ``broadcast_rows``; otherwise the join shuffles both sides, and
Spark splits the partitions of frequent shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WINDOW = 10
SHINGLE = 3
BROADCAST_ROWS = 1_000_000
#: Between words: ASCII other than letters and digits, once A-Z are lower-cased.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for null. ``lower`` would also
    change other letters, so it serves only texts that are all ASCII."""
    folded = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(folded, F.lit("")), NOT_WORD), "")


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, window_id, m, ws) per distinct window text and item; m is its number of words."""
    w = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text").cast("string")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    each = w.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", F.slice("w", F.col("at") + 1, window).alias("ws"))
    return each.distinct().select("item_id", F.concat_ws(" ", "ws").alias("window_id"), F.size("ws").alias("m"), "ws")


def window_shingles(windows: DataFrame) -> DataFrame:
    """(window_id, m, off, size, s0, s1, s2) of each distinct window: the
    shingle at word ``off``. Windows shorter than a shingle are one shingle;
    the words it lacks are empty, as no word is."""
    one = windows.select("window_id", "m", "ws").distinct()
    offs = F.sequence(F.lit(0), F.greatest(F.col("m") - SHINGLE, F.lit(0)))
    at = one.select("window_id", "m", "ws", F.explode(offs).alias("off"))
    return at.select("window_id", "m", "off", F.least("m", F.lit(SHINGLE)).alias("size"),
                     *(F.coalesce(F.get("ws", F.col("off") + k), F.lit("")).alias(f"s{k}") for k in range(SHINGLE)))


def _grams(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """A row per word position and shingle size: (doc_id, th, n_words, pos,
    s0, s1, s2, lead). ``lead`` marks one row of each document, without pos
    if it has no words."""
    text = F.col("text").cast("string")
    base = docs.select(F.col("doc_id").alias("doc_id"), F.xxhash64(text).alias("th"), words(text).alias("w"))
    shifted = [F.col("w").alias("s0"), *(F.slice("w", k + 1, F.greatest(F.size("w") - k, F.lit(0))).alias(f"s{k}") for k in range(1, SHINGLE))]
    rows = base.select("doc_id", "th", F.size("w").alias("n_words"), F.posexplode_outer(F.arrays_zip(*shifted)).alias("pos", "g"))
    full = [F.coalesce(F.col(f"g.s{k}"), F.lit("")).alias(f"s{k}") for k in range(SHINGLE)]
    lead = F.coalesce(F.col("pos") == 0, F.lit(True))
    if max(sizes, default=SHINGLE) == min(sizes, default=SHINGLE) == SHINGLE:
        return rows.select("doc_id", "th", "n_words", "pos", *full, lead.alias("lead"))
    # the benchmark has items of fewer words than a shingle: their sizes are matched as well
    rows = rows.select("doc_id", "th", "n_words", "pos", *full)
    cuts = F.array(*(F.struct(*((F.col(f"s{k}") if k < n else F.lit("")).alias(f"s{k}") for k in range(SHINGLE)), F.lit(n == SHINGLE).alias("full"))
                     for n in sorted({SHINGLE, *sizes})))
    each = rows.select("doc_id", "th", "n_words", "pos", F.explode(cuts).alias("g"))
    return each.select("doc_id", "th", "n_words", "pos", *(F.col(f"g.s{k}") for k in range(SHINGLE)), (F.col("g.full") & lead).alias("lead"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row of ``docs``.

    Reads doc_id and text of ``docs`` and item_id and text of ``items``; other
    columns are ignored. Null and empty texts have no words: such documents
    are clean and such items find nothing. Rows that repeat a doc_id with the
    same text get the same result; with another text they are judged apart.
    A null doc_id is kept. An item with a null id marks the words it hits but
    has no id to count or list; items that share an id count once. Empty
    tables give no rows, or clean documents.
    """
    wins = written(windows_of(items, window), "windows")
    shingles = written(window_shingles(wins), "shingles")
    names = [f"s{k}" for k in range(SHINGLE)]
    key = F.xxhash64(*names)
    wanted = shingles.select(*names).distinct().select(F.monotonically_increasing_id().alias("sid"), *names)
    wanted = written(wanted.withColumn("h", key), "wanted")
    sizes = sorted(r[0] for r in shingles.select("size").distinct().collect())  # 1 to SHINGLE
    small = F.broadcast if wanted.count() <= broadcast_rows else (lambda df: df)

    # 1. matches, and one row per document at its first word
    w = wanted.select(F.col("h").alias("wh"), F.col("sid"), *(F.col(n).alias(f"w{n}") for n in names))
    same = F.col("h") == F.col("wh")
    for n in names:  # written as a range, the words are compared after the hash and are no part of the join key
        same = same & F.col(n).between(F.col(f"w{n}"), F.col(f"w{n}"))
    grams = _grams(docs, sizes).withColumn("h", key)
    found = grams.join(small(w), same, "left").where("sid is not null or lead")
    matches = written(found.select("doc_id", "th", "n_words", "pos", "sid", "lead"), "matches")

    # 2. the rarest shingle of each window, and where it puts the window
    hits = matches.where("sid is not null").select("doc_id", "th", "n_words", "pos", "sid").distinct()
    counts = hits.groupBy("sid").agg(F.count("*").alias("n"))
    sid = wanted.select(F.col("sid").alias("wsid"), *(F.col(n).alias(f"w{n}") for n in names))
    on = F.col("s0") == F.col("ws0")
    for n in names[1:]:
        on = on & (F.col(n) == F.col(f"w{n}"))
    coded = shingles.join(sid, on).select("window_id", "m", "off", F.col("wsid").alias("sid"))
    ranked = coded.join(counts, "sid")  # a shingle without a match rules its windows out by itself
    parts = coded.groupBy("window_id", "m").agg(F.count("*").alias("need"), F.sort_array(F.collect_list(F.struct("off", "sid"))).alias("parts"))
    rarest = ranked.groupBy("window_id").agg(F.min(F.struct("n", "sid", "off")).alias("p"), F.count("*").alias("have"))
    prefix = written(rarest.join(parts, "window_id").where("have = need")
                     .select("window_id", "m", "need", "parts", F.col("p.sid").alias("psid"), F.col("p.off").alias("poff")), "prefix")
    place = hits.join(prefix, F.col("sid") == F.col("psid")).withColumn("start", F.col("pos") - F.col("poff"))
    place = place.where("start >= 0 and start + m <= n_words")

    # 3. every shingle of the window must have matched at its place
    claims = place.select("doc_id", "th", "start", "m", "need", "window_id", F.explode("parts").alias("part"))
    claims = claims.select("doc_id", "th", "start", "m", "need", "window_id", (F.col("start") + F.col("part.off")).alias("cpos"), F.col("part.sid").alias("csid"))
    m = hits.select(F.col("doc_id").alias("hdoc"), F.col("th").alias("hth"), F.col("pos").alias("hpos"), F.col("sid").alias("hsid"))
    agreed = claims.join(m, F.col("doc_id").eqNullSafe(F.col("hdoc")) & (F.col("th") == F.col("hth")) & (F.col("cpos") == F.col("hpos")) & (F.col("csid") == F.col("hsid")), "left_semi")
    proven = agreed.groupBy("doc_id", "th", "start", "m", "window_id").agg(F.count("*").alias("have"), F.first("need").alias("need")).where("have = need")
    proven = written(proven.select("doc_id", "th", "start", "m", "window_id"), "proven")

    covered = (proven.select("doc_id", "th", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("m") - 1)).alias("at")).distinct()
               .groupBy("doc_id", "th").agg(F.count("*").alias("n_hit")))
    named = (proven.select("doc_id", "th", "window_id").distinct().join(wins.select("item_id", F.col("window_id").alias("wid")), F.col("window_id") == F.col("wid"))
             .groupBy("doc_id", "th").agg(F.collect_set("item_id").alias("items")))
    a, b = covered.alias("a"), named.alias("b")
    per_doc = a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.th") == F.col("b.th")), "left").select(
        F.col("a.doc_id").alias("pdoc"), F.col("a.th").alias("pth"), "n_hit", "items")
    leads = matches.where("lead").select("doc_id", "th", F.col("n_words").cast("long").alias("n_words"))
    out = leads.join(per_doc, F.col("doc_id").eqNullSafe(F.col("pdoc")) & (F.col("th") == F.col("pth")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.sort_array(items), ","), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))
