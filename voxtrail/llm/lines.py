"""Line dedup: a suffix array over sequences of line ids by distributed prefix doubling; intervals of a longest common prefix reveal the repeated runs, and later copies are deleted. DataFrame operations only.

Ids and order: a text is its sequence of lines with a word; a line's id is the rank of its 128-bit hash among all lines that occur twice or more (the others are in no repeated run and leave at once). A rank is the place of a suffix's group in the suffix array: names are range-sorted, and the numbers of rows of the ranges before, then of the names before, are summed. In each round a suffix's rank by 2**k lines and that of the suffix 2**k lines on are sorted as a pair and give the rank by 2**(k+1) lines; rounds end when no group splits, or after the lines that a run of MIN_WORDS words can have at most, since no longer prefix decides anything here.

Runs: in the order of ranks each suffix is held against the two beside it, across the edges of ranges too. The longer of the two common prefixes is the longest that occurs twice at all, so it says which of the suffix's runs repeat: those of MIN_WORDS words that lose them without their first line, or without their last. The suffixes with a run in common are the interval of that prefix; its first place, in order of doc_id and line, stays, and the lines of the run go at all others. Longer repeated runs are unions of such runs, so a line goes if and only if it stands in a run of MIN_WORDS words or more that an earlier place has too. Runs are compared by the ids of their lines, not by hashes of runs.

Hot lines and runs: see hot_join(). A text's row is (doc_id, hash of text).

Defined results: a null text stays null, with no lines; lines without a word aren't compared, and go only with the run around them; a null doc_id comes last in order; rows repeated in full (doc_id and text) are one document and get the same answer; an empty table gives an empty result; other columns are ignored by dedup_lines().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, hot_join, n_words

MIN_WORDS = 50
#: Names or suffixes in one range of the order, on average.
RANGE_ROWS = 100_000
LAST = (1 << 63) - 1
PLACE = ("row", "text_key", "pos")


def text_keys(doc_id: str, text: str) -> list[Column]:
    """row and text_key: null ids come last and apart from the largest id."""
    row = F.col(doc_id).cast("long")
    key = F.when(row.isNull(), F.xxhash64(F.lit("none"), F.col(text))).otherwise(F.xxhash64(text))
    return [F.coalesce(row, F.lit(LAST)).alias("row"), key.alias("text_key")]


def ordered(df: DataFrame, keys: list[str], total: int, scratch: Scratch, name: str) -> DataFrame:
    """df, of up to total rows, in the order of keys: part, the number of its range, and mid, which rises within a range."""
    parts = max(1, -(-total // RANGE_ROWS))
    rows = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("mid", F.monotonically_increasing_id())
    return scratch.table(rows.withColumn("part", F.shiftright("mid", 33)), name)


def ranked(names: DataFrame, keys: list[str]) -> DataFrame:
    """Ordered names (keys and n, the rows of a name) with rank, one more than the rows of all names before."""
    sums = names.groupBy("part").agg(F.sum("n").alias("all"))  # one row for each range
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("all").over(before(W.orderBy("part"))), F.lit(0)).alias("start"))
    inside = F.coalesce(F.sum("n").over(before(W.partitionBy("part").orderBy("mid"))), F.lit(0))
    return names.join(F.broadcast(starts), "part").select(*keys, "n", (F.col("start") + inside + 1).alias("rank"))


def numbered_lines(docs: DataFrame, scratch: Scratch, doc_id: str, text: str) -> DataFrame:
    """(row, text_key, pos, at, words, left, id, rank) of the lines that occur twice or more: pos counts lines with words, at all lines, left those with words from here on."""
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("at"), F.xxhash64(x).alias("h1"), F.xxhash64(F.lit("line"), x).alias("h2"), n_words(x).alias("words"))), lambda s: s["words"] > 0)
    df = docs.select(*text_keys(doc_id, text), lines.alias("lines"))
    df = df.select("row", "text_key", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    df = scratch.table(df.select(*PLACE, (F.col("n_lines") - F.col("pos")).alias("left"), "line.*"), "lines")
    total, keys = df.count(), ["h1", "h2"]
    names = ordered(df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), keys, total, scratch, "ids")
    found = hot_join(df, ranked(names, keys), keys, total, names).dropDuplicates(list(PLACE))
    found = scratch.table(found.select(*PLACE, "at", "words", "left", F.col("rank").alias("id"), "rank"), "numbered")
    scratch.drop("lines")
    return found


def suffix_ranks(lines: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """lines with rank: the order of the suffixes by their first most lines or more."""
    by_text = W.partitionBy("row", "text_key").orderBy("pos")
    total, groups, half, k, keys, state = lines.count(), -1, 1, 0, ["first", "second"], lines
    while half < most:
        # what follows a run's end sorts first; a line that occurs once makes its suffix one of a kind
        ahead = F.max("rank").over(by_text.rangeBetween(half, half))
        once = -F.abs(F.xxhash64(*PLACE) % LAST) - 1
        second = F.when(F.col("left") <= half, 0).otherwise(F.coalesce(ahead, once))
        pairs = scratch.table(state.withColumn("second", second).withColumnRenamed("rank", "first"), f"pairs-{k}")
        names = ordered(pairs.groupBy(*keys).agg(F.count("*").alias("n")), keys, total, scratch, f"names-{k}")
        count = names.count()
        if count == groups:  # no group has split, so none will
            return pairs.withColumnRenamed("first", "rank").select(*lines.columns)
        state = hot_join(pairs, ranked(names, keys), keys, total, names).select(*lines.columns)
        groups, half, k = count, 2 * half, k + 1
        if k > 1:
            scratch.drop(f"pairs-{k - 2}")
            scratch.drop(f"names-{k - 2}")
    return state


def common_prefix(a: Column, b: Column) -> Column:
    """The number of equal entries at the start of two arrays; 0 if one is null."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.coalesce(F.when(differ == 0, F.size(a)).otherwise(differ - 1), F.lit(0)).cast("int")


def repeated_runs(docs: DataFrame, scratch: Scratch, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(name, row, text_key, pos, first, last): the shortest runs of min_words words that occur twice or more; name is the array of their lines' ids, first and last are line numbers."""
    lines = numbered_lines(docs, scratch, doc_id, text)
    ranks = suffix_ranks(lines, scratch, min_words)
    # the lines from here on, as far as they occur twice and the words without the first line's are too few
    ahead = F.collect_list(F.struct("pos", "id", "words", "at")).over(W.partitionBy("row", "text_key").orderBy("pos").rangeBetween(0, min_words - 1))
    rows = ranks.select(*PLACE, "rank", F.filter(ahead, lambda x, i: x["pos"] == F.col("pos") + i).alias("run"))
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("rest"), F.lit(0).alias("short"), F.lit(0).alias("most"))

    def count(s: Column, x: Column) -> Column:
        """short: lines whose words together are too few; most: lines without the first line's words too few."""
        sum_, rest = s["sum"] + x["words"], F.when(s["most"] == 0, F.lit(0).cast("long")).otherwise(s["rest"] + x["words"])
        inside = (rest < min_words) & (s["rest"] < min_words)
        return F.struct(sum_.alias("sum"), F.when(inside, rest).otherwise(F.lit(LAST >> 1)).alias("rest"), (s["short"] + (sum_ < min_words).cast("int")).alias("short"), (s["most"] + inside.cast("int")).alias("most"))

    rows = rows.withColumn("m", F.aggregate("run", start, count)).where(F.col("m.sum") >= min_words)
    rows = rows.select(*PLACE, "rank", (F.col("m.short") + 1).alias("least"), F.slice("run", F.lit(1), F.greatest(F.col("m.most"), F.col("m.short") + 1)).alias("run"))
    rows = rows.select(*PLACE, "rank", "least", F.col("run.id").alias("ids"), F.col("run.at").alias("at"))
    sa = ordered(rows, ["rank", *PLACE], lines.count(), scratch, "array")
    inside = W.partitionBy("part").orderBy("mid")
    sa = sa.withColumns({"before": F.lag("ids").over(inside), "after": F.lead("ids").over(inside), "first": F.row_number().over(inside) == 1})
    # the suffixes at the edges of the ranges: one row for each range, in one task
    edges = sa.where(F.col("first") | F.col("after").isNull()).groupBy("part").agg(F.min_by("ids", "mid").alias("low"), F.max_by("ids", "mid").alias("high"))
    across = W.orderBy("part")
    edges = edges.select(F.col("part"), F.lag("high").over(across).alias("from"), F.lead("low").over(across).alias("to"))
    sa = sa.join(F.broadcast(edges), "part")
    lcp = F.greatest(common_prefix(F.col("ids"), F.coalesce("before", F.when(F.col("first"), F.col("from")))), common_prefix(F.col("ids"), F.coalesce("after", "to")))
    sa = sa.withColumn("lcp", lcp).where("lcp >= least").withColumn("m", F.explode(F.sequence("least", "lcp")))
    return scratch.table(sa.select(F.slice("ids", F.lit(1), F.col("m")).alias("name"), *PLACE, F.element_at("at", 1).alias("first"), F.element_at("at", F.col("m")).alias("last")), "runs")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed and text without the later copies, for every row."""
    scratch = Scratch(docs.sparkSession, "lines")
    runs = repeated_runs(docs, scratch, min_words, doc_id, text)
    place = F.struct(*PLACE)
    names = scratch.table(runs.groupBy("name").agg(F.min(place).alias("origin"), F.count("*").alias("n")), "names")
    later = hot_join(runs, names, ["name"], runs.count()).where(place > F.col("origin"))
    gone = later.groupBy("row", "text_key").agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("first", "last")))).alias("gone"))
    gone = scratch.table(gone.select(F.col("row").alias("gone_row"), F.col("text_key").alias("gone_key"), "gone"), "gone")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *text_keys(doc_id, text)).hint("merge")
    joined = rows.join(gone, (rows["row"] == gone["gone_row"]) & (rows["text_key"] == gone["gone_key"]), "left").select("doc_id", "text", "gone", F.split("text", "\n", -1).alias("lines"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"), lambda i: F.element_at("lines", i + 1))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select("doc_id", n_lines.alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), text.alias("text"))


def oracle_sql(min_words: int = MIN_WORDS) -> str:
    """dedup_lines() over documents of distinct ids in DuckDB's SQL, by the text of every shortest run from and to each line."""
    words = r"len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))"
    return f"""
WITH t AS MATERIALIZED (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
ln AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS pos, sum(n) OVER (PARTITION BY doc_id ORDER BY k) AS c
  FROM (SELECT doc_id, k, x, {words} AS n FROM (SELECT doc_id, unnest(range(len(l))) AS k, unnest(l) AS x FROM t)) WHERE n > 0),
li AS (SELECT doc_id, list(x ORDER BY pos) AS xs FROM ln GROUP BY doc_id),
runs AS MATERIALIZED (SELECT a.doc_id, a.pos, a.k AS first, b.k AS last, md5(array_to_string(xs[a.pos:b.pos], chr(10))) AS name
  FROM ln a JOIN ln b ON a.doc_id = b.doc_id AND b.pos >= a.pos JOIN li ON li.doc_id = a.doc_id
  WHERE b.c - a.c + a.n >= {min_words} AND (b.c - a.c + a.n - b.n < {min_words} OR b.c - a.c < {min_words})),
origins AS (SELECT name, min({{'d': doc_id, 'p': pos}}) AS o FROM runs GROUP BY name),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS k FROM runs JOIN origins USING (name) WHERE {{'d': doc_id, 'p': pos}} > o),
g AS (SELECT doc_id, list(k) AS gs FROM gone GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gs), 0) AS BIGINT) AS n_removed,
  CASE WHEN gs IS NULL THEN text ELSE array_to_string(list_filter(l, lambda x, i: NOT list_contains(gs, i - 1)), chr(10)) END AS text
FROM t LEFT JOIN g ON g.doc_id = t.doc_id"""
