"""Benchmark decontamination over a positional inverted index, in DataFrame operations only.

The index holds, for each term that a test window can be looked up by, its postings (document, position)
in the training texts; it is a stored table. Terms are counted over all training texts first. A window of
consecutive test words is looked up by its rarest terms: the postings of each, shifted back by the term's
place in the window, give the starts where the window could stand, and the lists are intersected from the
rarest on. What is left is compared word by word with the text (exact phrase). For proximity (``near``) the postings
need only lie close to each other, and then all terms of the window must stand within so many consecutive words, in
any order; a term that the window repeats must stand there once. Texts are split into words once, into a stored table.

Everything that is broadcast is counted first (``MAX_BROADCAST`` rows at most); beyond that the same join
is shuffled.

Defined results: null and empty texts have no words and no hits; an item without words is no window, one
with fewer words than a window is a window of all its words. Windows of several items with the same words
count for each of the items. Repeated test rows count once; repeated documents are separate rows. A null
id of a document is kept; items without an id cannot be named and are left out. Other columns are ignored.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import table
from chatloom.session import materialize

WINDOW = 10
#: Terms of a window whose postings are intersected before words are compared.
LOOKUPS = 2
MAX_BROADCAST = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text; A-Z in lower case. Null has none."""
    text = F.coalesce(text, F.lit(""))
    # lower() knows more letters than A-Z, which only matters where there are other letters.
    plain = F.octet_length(text) == F.char_length(text)
    folded = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(folded, GAPS), lambda w: w != "")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, whole`` name a document: its id and a hash of its text. Rows that repeat both are alike."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("whole"), words(F.col(text_col)).alias("words"))
    return split.withColumn("n_words", F.size("words").cast("long"))


def windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``window, items, terms, n``: the distinct windows and the items that hold them."""
    rows = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w"))
    n = F.size("w")
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    cut = rows.where(n > 0).select("item", F.explode(starts).alias("at"), "w")
    cut = cut.select("item", F.slice("w", F.col("at"), F.least(F.lit(size), F.size("w"))).alias("terms"))
    whole = cut.groupBy("terms").agg(F.collect_set("item").alias("items"))
    # Two hashes name a window: its words are compared as text in any case.
    return whole.select(F.xxhash64("terms").alias("window"), "items", "terms", F.size("terms").alias("n"))


def bounded(small: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few rows; else the join is shuffled."""
    return F.broadcast(small) if small.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST else small


def only(docs: DataFrame, by_doc: DataFrame) -> DataFrame:
    """``docs`` without most rows that ``by_doc`` does not name, if the named texts are few enough for a broadcast: so other
    words are not shuffled. Beyond that all rows, of which the join that follows takes the same."""
    named = by_doc.select(F.col("_whole").alias("whole")).distinct()
    few = named.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    return docs.join(F.broadcast(named), "whole", "left_semi").select(docs.columns) if few else docs


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, tf`` of each of ``terms``, over all documents (0 where it does not occur)."""
    tokens = docs.select(F.explode("words").alias("term"))
    # Other terms are left out before anything is counted.
    counted = tokens.join(bounded(terms), "term", "left_semi").groupBy("term").agg(F.count("*").alias("tf"))
    return terms.join(counted, "term", "left").select("term", F.coalesce("tf", F.lit(0)).alias("tf"))


def lookups(cut: DataFrame, counts: DataFrame, most: int = LOOKUPS) -> DataFrame:
    """``window, rank, term, place``: the rarest terms of each window (rank 1 first), ties by place. Windows
    with a term that never occurs are left out."""
    places = cut.select("window", "n", F.posexplode("terms").alias("place", "term"))
    ranked = places.join(counts, "term").groupBy("window").agg(
        F.min("tf").alias("least"), F.array_sort(F.collect_list(F.struct("tf", "place", "term"))).alias("ranked")
    )
    ranked = ranked.where("least > 0").select("window", F.posexplode(F.slice("ranked", 1, most)).alias("rank", "r"))
    return ranked.select("window", (F.col("rank") + 1).alias("rank"), "r.term", "r.place")


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored postings ``term, id, whole, at`` of ``terms``."""
    tokens = docs.select("id", "whole", F.posexplode("words").alias("at", "term"))
    return materialize(tokens.join(bounded(terms), "term").select("term", "id", "whole", "at"), "postings")


def candidates(index: DataFrame, looked: DataFrame, most: int = LOOKUPS) -> DataFrame:
    """``id, whole, window, start``: where the shifted postings of a window's rarest terms agree."""
    found = None
    size = looked.groupBy("window").agg(F.max("rank").alias("last"))
    for rank in range(1, most + 1):
        terms = looked.where(F.col("rank") == rank).select("term", "window", "place")
        starts = index.join(bounded(terms), "term").select(
            "id", "whole", "window", (F.col("at") - F.col("place")).alias("start")
        )
        starts = starts.where("start >= 0").distinct()
        if found is None:
            found = starts
            continue
        # Windows of fewer terms have no list of this rank and pass.
        short = bounded(size.where(F.col("last") < rank).select("window"))
        found = materialize(found, "starts")
        both = found.alias("a").join(
            starts.alias("b"),
            (F.col("a.whole") == F.col("b.whole"))
            & (F.col("a.window") == F.col("b.window"))
            & (F.col("a.start") == F.col("b.start"))
            & F.col("a.id").eqNullSafe(F.col("b.id")),
            "left_semi",
        )
        found = both.union(found.join(short, "window", "left_semi").select(both.columns))
    return found


def phrases(docs: DataFrame, cut: DataFrame, index: DataFrame, looked: DataFrame) -> DataFrame:
    """``id, whole, start, n, items``: every place where all words of a window stand one after another."""
    found = materialize(candidates(index, looked), "candidates").distinct()
    whole = found.join(cut.select("window", "terms", "items", "n"), "window")
    by_doc = whole.groupBy("id", "whole").agg(F.collect_list(F.struct("start", "n", "terms", "items")).alias("tries"))
    by_doc = materialize(by_doc, "tries").withColumnRenamed("id", "_id").withColumnRenamed("whole", "_whole")
    # Only documents with a candidate are read again, and each once.
    texts = only(docs, by_doc).join(by_doc, (F.col("whole") == F.col("_whole")) & F.col("id").eqNullSafe(F.col("_id")))
    right = F.filter("tries", lambda t: F.slice(F.col("words"), t["start"] + 1, t["n"]) == t["terms"])
    return texts.select("id", "whole", right.alias("right")).where(F.size("right") > 0).dropDuplicates(["id", "whole"])


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", near: int | None = None) -> DataFrame:
    """Per row of ``docs``: ``id, whole, n_words, n_hit, item_list`` (of the items' ids as strings, sorted).

    With ``near`` also ``near_list``: the items of which all terms of a window stand within ``near`` words.
    """
    named = materialize(keyed(docs, id_col, text_col), "texts")
    cut = materialize(windows(items, item_col, item_text, size), "windows")
    terms = cut.select(F.explode("terms").alias("term")).distinct()
    counts = materialize(term_counts(named, terms), "counts")
    looked = materialize(lookups(cut, counts), "lookups")
    index = build_index(named, looked.select("term").distinct())
    right = phrases(named, cut, index, looked)
    covered = F.transform("right", lambda r: F.sequence(r["start"], r["start"] + r["n"] - 1))
    hits = right.select(
        F.col("id").alias("_id"),
        F.col("whole").alias("_whole"),
        F.size(F.array_distinct(F.flatten(covered))).cast("long").alias("n_hit"),
        item_names("right").alias("item_list"),
    )
    hits = materialize(hits, "hits")
    same = (F.col("whole") == F.col("_whole")) & F.col("id").eqNullSafe(F.col("_id"))
    none = F.array().cast("array<string>")
    found = named.select("id", "whole", "n_words").join(hits, same, "left").drop("_id", "_whole")
    columns = ["id", "whole", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_list", none).alias("item_list")]
    if near is not None:
        close = near_windows(named, cut, index, looked, near).select(
            F.col("id").alias("_id"), F.col("whole").alias("_whole"), item_names("close").alias("near_list")
        )
        found = found.join(materialize(close, "near"), same, "left")
        columns.append(F.coalesce("near_list", none).alias("near_list"))
    return found.select(*columns)


def item_names(windows_col: str) -> Column:
    """The distinct items of an array of windows as sorted strings."""
    ids = F.flatten(F.transform(windows_col, lambda w: w["items"]))
    return F.array_sort(F.array_distinct(F.transform(ids, lambda i: i.cast("string"))))


def near_windows(docs: DataFrame, cut: DataFrame, index: DataFrame, looked: DataFrame, width: int) -> DataFrame:
    """``id, whole, close``: of each document the windows of which all terms stand within ``width`` words."""
    spots = near_phrases(index, looked, width).groupBy("id", "whole", "window").agg(F.collect_set("at").alias("spots"))
    spots = spots.join(cut.select("window", F.array_distinct("terms").alias("terms"), "items"), "window")
    by_doc = spots.groupBy("id", "whole").agg(F.collect_list(F.struct("spots", "terms", "items")).alias("tries"))
    by_doc = materialize(by_doc, "near_tries").withColumnRenamed("id", "_id").withColumnRenamed("whole", "_whole")
    texts = only(docs, by_doc).join(by_doc, (F.col("whole") == F.col("_whole")) & F.col("id").eqNullSafe(F.col("_id")))

    def fits(window):
        holds = lambda start: F.size(F.array_intersect(window["terms"], F.slice(F.col("words"), start + 1, width))) == F.size(window["terms"])
        # A stretch with the rarest term at ``at`` starts there or before.
        return F.exists(window["spots"], lambda at: F.exists(F.sequence(F.greatest(at - width + 1, F.lit(0)), at), holds))

    close = texts.select("id", "whole", F.filter("tries", fits).alias("close"))
    return close.where(F.size("close") > 0).dropDuplicates(["id", "whole"])


def near_phrases(index: DataFrame, looked: DataFrame, width: int) -> DataFrame:
    """Places ``id, whole, window, at`` of a window's rarest term that have its second rarest within ``width`` words,
    before or behind. Windows of one term have no second and all their places count."""
    found = None
    size = looked.groupBy("window").agg(F.max("rank").alias("last"))
    for rank in range(1, LOOKUPS + 1):
        terms = looked.where(F.col("rank") == rank).select("term", "window")
        places = index.join(bounded(terms), "term").select("id", "whole", "window", "at")
        if found is None:
            found = places
            continue
        # A place lies in one block of ``width`` and is looked for in the blocks beside it.
        blocks = F.explode(F.array(*[F.floor(F.col("at") / width) + k for k in (-1, 0, 1)]))
        a = found.withColumn("block", F.floor(F.col("at") / width)).alias("a")
        b = places.withColumn("block", blocks).alias("b")
        close = F.abs(F.col("a.at") - F.col("b.at")) < width
        same = (F.col("a.whole") == F.col("b.whole")) & (F.col("a.window") == F.col("b.window")) & (F.col("a.block") == F.col("b.block"))
        short = bounded(size.where(F.col("last") < rank).select("window"))
        both = a.join(b, same & close & F.col("a.id").eqNullSafe(F.col("b.id")), "left_semi").select("id", "whole", "window", "at")
        found = both.union(found.join(short, "window", "left_semi").select(both.columns))
    return found.distinct()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, hit words, and the items whose windows occur."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("item_list").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_list", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
spots AS (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM b WHERE len(w) > 0),
win AS (SELECT item_id, list_slice(w, pos, pos + least(10, len(w)) - 1) AS terms FROM spots),
sizes AS (SELECT DISTINCT len(terms) AS n FROM win),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, pos, n, item_id FROM (SELECT doc_id, pos, n, list_slice(w, pos, pos + n - 1) AS terms FROM places) p JOIN win USING (terms)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: ``docs`` without the rows that hold a window of a benchmark item. Other rows of the
    same id, or without one, stay."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = found.where("n_hit > 0").select(F.col("id").alias("_id"), F.col("whole").alias("_whole")).distinct()
    bad = materialize(bad, "bad")
    whole = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (whole == bad["_whole"]), "left_anti")
