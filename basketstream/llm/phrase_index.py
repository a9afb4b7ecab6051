r"""Benchmark decontamination by a distributed positional inverted index.

Built-in Spark expressions only. Words are runs of characters other than ASCII
signs, with A-Z lower-cased.

*Index.* Every word of every document that a test item uses is a posting (term, row,
pos), in a table in the shared folder. Term ids keep it narrow, and as each map task
writes the postings of its own documents, nothing is shuffled. One row per document
is in it besides (``pos`` 0, or null without words).

*Windows.* An item's runs of ``WINDOW`` words, or the whole item if it is shorter.
Equal windows of several items are searched once. Terms of a window are ranked by
their number of postings; a window with a term that the corpus lacks is left out.

*Intersection.* A posting of term t at p puts a window with t at offset o to start
p - o. The lists of the two rarest terms are intersected on (row, start); what is
left is a candidate. All other terms of the candidates are then asked of the lists of
the candidates' documents at once, and a candidate with all answers is a match. Very
frequent words are hardly ever among the two rarest, and a window made of frequent
words alone costs their lists, not products of them: both joins are equi joins on
(row, term, place).

*Proximity.* With ``slack`` above 0 every other term may lie up to ``slack`` words off
its place as seen from the rarest term (the first of several). Places become bins of ``2 slack + 1`` words,
of which a term is looked up in the two that can hold it; exact search is the case of
bins of one word.

Defined cases: a null or empty text, of a document or an item, has no words and
matches nothing; repeated documents are judged one by one, also with null ids;
repeated items count once by id; an empty table of documents gives an empty result, an
empty table of items marks nothing; further columns are ignored. A very long document
is one row of the input and many short ones from the first step on.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketstream.llm.common import write_once

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
# Tables are broadcast up to so many rows of two to four numbers, or one word.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _small(df: DataFrame) -> DataFrame:
    """``df``, which is written already, with the broadcast hint if it has few rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


class Phrases:
    """Windows of test items.

    ``terms``: word, term. ``places``: window, offset, term. ``items``: window, item_id.
    """

    def __init__(self, items: DataFrame, window: int = WINDOW, id_column="item_id", text_column="text"):
        split = items.select(F.col(f"`{id_column}`").alias("item_id"), words(F.col(f"`{text_column}`")).alias("words")).where(F.size("words") > 0)
        last = F.greatest(F.size("words") - window, F.lit(0))
        cut = split.select("item_id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda s: F.slice("words", s + 1, window))).alias("words"))
        cut = write_once(cut.distinct(), "item-windows")
        self.terms = write_once(cut.select(F.explode("words").alias("word")).distinct().select(
            "word", F.monotonically_increasing_id().alias("term")), "terms")
        known = write_once(cut.select("words").distinct().select("words", F.monotonically_increasing_id().alias("window")), "windows")
        self.items = write_once(cut.join(known, "words").select("window", "item_id"), "window-items")
        self.places = write_once(known.select("window", F.posexplode("words").alias("offset", "word")).join(
            self.terms, "word").select("window", "offset", "term"), "places")


def index(docs: DataFrame, terms: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """Written postings: row, id, n_words, pos, term; term is null in rows that only stand for the document."""
    split = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("id"),
                        words(F.col(f"`{text_column}`")).alias("words"))
    tokens = split.select("row", "id", F.size("words").cast("long").alias("n_words"), F.posexplode_outer("words").alias("pos", "word"))
    found = tokens.join(_small(terms), "word", "left").where("term IS NOT NULL OR pos IS NULL OR pos = 0")
    return write_once(found.select("row", "id", "n_words", "pos", "term"), "postings")


def _lookup(asked: DataFrame, postings: DataFrame, slack: int) -> DataFrame:
    """Rows of ``asked`` (row, term, at, ...) for which a posting lies within ``slack`` of ``at``; maybe repeated if slack > 0."""
    width = 2 * slack + 1
    bins = F.array_distinct(F.array(F.floor((F.col("at") - slack) / width), F.floor((F.col("at") + slack) / width)))
    there = postings.select("row", "term", "pos", F.floor(F.col("pos") / width).alias("bin"))
    return asked.withColumn("bin", F.explode(bins)).join(there, ["row", "term", "bin"]).where(
        F.abs(F.col("pos") - F.col("at")) <= slack).drop("bin", "pos")


def search(postings: DataFrame, phrases: Phrases, slack: int = 0) -> DataFrame:
    """window, row, start, length of every match; ``start`` is where the rarest term puts the window's first word."""
    lists = postings.where("term IS NOT NULL").select("row", "pos", "term")
    counts = lists.groupBy("term").agg(F.count("*").alias("n"))
    # A left join: a window with a term that never occurs has a null count and goes.
    counted = phrases.places.join(counts, "term", "left")
    ranked = counted.groupBy("window").agg(
        F.count("*").alias("length"), F.count("n").alias("known"),
        F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("by_rank")).where("length = known").drop("known")
    ranked = write_once(ranked, "ranked")
    first, second = F.col("by_rank")[0], F.try_element_at("by_rank", F.lit(2))
    anchors = ranked.select("window", "length", first["term"].alias("term"), first["offset"].alias("offset"),
                            second["term"].alias("next_term"), second["offset"].alias("next_offset"))
    placed = lists.join(_small(anchors), "term").select(
        "window", "length", "row", (F.col("pos") - F.col("offset")).alias("start"), F.col("next_term").alias("term"), "next_offset")
    alone = placed.where("length = 1").select("window", "row", "start", "length")
    asked = placed.where("length > 1").select("window", "row", "start", "length", "term", (F.col("start") + F.col("next_offset")).alias("at"))
    seconds = write_once(anchors.select(F.col("next_term").alias("term")).where("term IS NOT NULL").distinct(), "second-terms")
    pairs = _lookup(asked, lists.join(_small(seconds), "term", "left_semi"), slack).select("window", "row", "start", "length").distinct()
    pairs = write_once(pairs, "candidates")
    rest = ranked.select("window", F.explode(F.slice("by_rank", 3, 1 << 20)).alias("place"))
    wanted = pairs.join(_small(rest.select("window", "place.term", "place.offset")), "window").select(
        "window", "row", "start", "length", "term", "offset", (F.col("start") + F.col("offset")).alias("at"))
    rows = write_once(pairs.select("row").distinct(), "candidate-rows")
    answered = _lookup(wanted, lists.join(_small(rows), "row", "left_semi"), slack)
    answers = F.count("*") if slack == 0 else F.count_distinct("offset")
    full = answered.groupBy("window", "row", "start", "length").agg(answers.alias("answers")).where(
        F.col("answers") == F.col("length") - 2).drop("answers")
    return alone.unionByName(pairs.where("length = 2")).unionByName(full)


def mark_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_column="doc_id", text_column="text",
                   item_column="item_id", item_text_column="text") -> DataFrame:
    """id, n_words, n_hit, n_items, items (sorted as strings), spans (start, length) of every document.

    ``spans`` are the hit words, overlapping and touching windows as one.
    """
    phrases = Phrases(items, window, item_column, item_text_column)
    postings = index(docs, phrases.terms, id_column, text_column)
    matches = write_once(search(postings, phrases), "matches")
    ends = matches.groupBy("row", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = Window.partitionBy("row").orderBy("start")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opened = ends.withColumn("new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    runs = opened.withColumn("run", F.sum("new").over(before)).groupBy("row", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    spans = runs.groupBy("row").agg(
        F.sum(F.col("end") - F.col("start")).alias("n_hit"),
        F.sort_array(F.collect_list(F.struct("start", (F.col("end") - F.col("start")).alias("length")))).alias("spans"))
    found = matches.select("row", "window").distinct().join(phrases.items, "window").groupBy("row").agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    every = postings.where("pos IS NULL OR pos = 0").select("row", "id", "n_words")
    return every.join(spans, "row", "left").join(found, "row", "left").select(
        "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans")


def near_matches(docs: DataFrame, items: DataFrame, slack: int, window: int = WINDOW, id_column="doc_id", text_column="text",
                 item_column="item_id", item_text_column="text") -> DataFrame:
    """id, item_id, start, length of windows whose words all lie within ``slack`` of their places."""
    phrases = Phrases(items, window, item_column, item_text_column)
    postings = index(docs, phrases.terms, id_column, text_column)
    ids = postings.where("pos IS NULL OR pos = 0").select("row", "id")
    return search(postings, phrases, slack).join(phrases.items, "window").join(ids, "row").select("id", "item_id", "start", "length").distinct()
