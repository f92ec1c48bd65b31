"""Line deduplication over a whole corpus by a deletion-neighbourhood join. DataFrame operations only.

Lines are what line feeds separate. A line is its sequence of words: split at ASCII white space, lower-cased. Two lines
match if at most one word is inserted, deleted or replaced (edit distance over words of at most 1). A line with words is dropped if an
equal line occurs earlier, by doc_id and line number, or, where both have at least ``min_words`` words, another line that matches it; lines
dropped themselves count as earlier ones. Of shorter lines one word is too much to be the same line, so only equal ones count. Blank lines are never dropped.

1. Equal lines are gathered by 128 bits of hash, with a map-side combine; each distinct line is its first occurrence.
2. A line one edit away from another shares its first or its last half with it. Lines without such a partner have
   no match, so only the others (all of them) go on.
3. Deletion neighbourhood: each line emits its own key and, for each word, the key of the line without that word. Keys
   are sums of hashes of (word, place), so that all keys of a line come from running sums, whatever its length.
4. Lines that match share a key: at the same deleted place if a word was replaced, else one deletes a word and the
   other does not. Per key the earliest line of each kind is aggregated and joined back, so that a key held by very many
   lines costs one row for each. No pairs within a group are made: whether a line goes depends on the earliest partner.
5. The words of each candidate pair are compared, which settles the edit distance whatever the hashes did.

NULL texts have no lines; an empty text is one empty line. Rows with a NULL doc_id take no part and keep their lines. Rows
with one doc_id count as one document: what occurs first in several of them is kept in each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize, measure, passing

MIN_WORDS = 5
#: Up to so many lines (of 28 bytes) with a possible partner are sent to all tasks instead of moving all texts.
BROADCAST_ROWS = 500_000
_SUM_BITS = 40


def _words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.translate(line, "\t\r\x0b\x0c", "    ")), " "), "")


def _exploded(docs: DataFrame) -> DataFrame:
    rows = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    return rows.select("doc_id", "row", "line_no", _words(F.col("line")).alias("words"))


def _halves(words: Column, n: Column) -> Column:
    """Hashes of the first and last halves, for the line's own length and for one word less."""
    half, less = F.shiftright(n, 1), F.shiftright(F.greatest(n - 1, F.lit(0)), 1)
    first = [F.xxhash64(F.lit(1), F.slice(words, 1, k)) for k in (half, less)]
    last = [F.xxhash64(F.lit(2), F.slice(words, k, n)) for k in (half + 1, less + 2)]
    return F.array_distinct(F.array(*first, *last))


def hashed_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, row, line_no, n, h1, h2, halves)`` of every line, stored as a table; ``row`` tells texts of one doc_id apart."""
    words, n = F.col("words"), F.size("words")
    rows = _exploded(docs).select(
        "doc_id", "row", "line_no", n.alias("n"), F.xxhash64(words).alias("h1"), F.xxhash64(F.lit(7), words).alias("h2"), _halves(words, n).alias("halves")
    )
    return materialize(rows, "lines")


def _with_partner(distinct: DataFrame) -> DataFrame:
    """Distinct lines that share a half with another one."""
    halves = distinct.select("first", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("lines")).filter("lines > 1").select("half")
    return halves.join(shared, "half").select("first").distinct().select("first.*")


def _keys(lines: DataFrame) -> DataFrame:
    """``(k1, k2, place, first)``: the keys of the deletion neighbourhood; place is -1 for the line itself."""
    spread = lines.select("first", F.posexplode("words").alias("i", "word"))
    terms = {}
    for k in (1, 2):
        terms[f"here{k}"] = F.pmod(F.xxhash64(F.lit(k), "word", "i"), F.lit(1 << _SUM_BITS))
        terms[f"moved{k}"] = F.pmod(F.xxhash64(F.lit(k), "word", F.col("i") - 1), F.lit(1 << _SUM_BITS))
    spread = spread.select("first", "i", *[c.alias(name) for name, c in terms.items()])
    line = Window.partitionBy("first")
    through = line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {f"s_{name}": F.sum(name).over(through) for name in terms} | {f"t_{name}": F.sum(name).over(line) for name in ("moved1", "moved2")}
    sums["n"] = F.count("*").over(line)
    summed = spread.withColumns(sums)
    without = [(F.col(f"s_here{k}") - F.col(f"here{k}") + F.col(f"t_moved{k}") - F.col(f"s_moved{k}")).alias(f"k{k}") for k in (1, 2)]
    deleted = F.struct(*without, F.col("i").alias("place"))
    itself = F.struct(F.col("s_here1").alias("k1"), F.col("s_here2").alias("k2"), F.lit(-1).alias("place"))
    offers = F.when(F.col("i") == F.col("n") - 1, F.array(deleted, itself)).otherwise(F.array(deleted))
    return summed.select("first", F.explode(offers).alias("x")).select("x.*", "first")


def _candidates(keys: DataFrame) -> DataFrame:
    """``(first, other)``: each line with the earliest lines it shares a key with, if they come before it."""
    by_place = keys.groupBy("k1", "k2", "place").agg(F.min("first").alias("least"), F.count("*").alias("lines"))
    by_key = by_place.groupBy("k1", "k2").agg(
        F.min(F.when(F.col("place") < 0, F.col("least"))).alias("whole"),
        F.min(F.when(F.col("place") >= 0, F.col("least"))).alias("shortened"),
        F.collect_list(F.struct("place", "least")).alias("places"),
        F.sum("lines").alias("lines"),
    )
    shared = by_key.filter("lines > 1").select("k1", "k2", "whole", "shortened", F.explode("places").alias("p")).select("k1", "k2", "whole", "shortened", "p.*")
    joined = keys.join(shared, ["k1", "k2", "place"])
    opposite = F.when(F.col("place") < 0, F.col("shortened")).otherwise(F.col("whole"))
    pairs = joined.select("first", F.explode(F.array_distinct(F.array("least", opposite))).alias("other"))
    return pairs.filter(F.col("other") < F.col("first")).distinct()


def _one_edit(a: Column, b: Column) -> Column:
    """True if the word arrays differ by at most one inserted, deleted or replaced word."""
    na, nb = F.size(a), F.size(b)
    short = F.least(na, nb)

    def agree(x: Column, y: Column) -> Column:
        """How many words agree from the start."""
        differs = F.zip_with(F.slice(x, 1, short), F.slice(y, 1, short), lambda p, q: p != q)
        at = F.array_position(differs, True)
        return F.when(at == 0, short.cast("long")).otherwise(at - 1)

    return (F.abs(na - nb) <= 1) & (agree(a, b) + agree(F.reverse(a), F.reverse(b)) >= F.greatest(na, nb) - 1)


def dropped_lines(docs: DataFrame, min_words: int = MIN_WORDS, broadcast_rows: int = BROADCAST_ROWS, lines: DataFrame | None = None) -> DataFrame:
    """``(doc_id, row, line_no)`` of the lines to drop; ``lines`` are the ``hashed_lines`` of ``docs``, if they are at hand."""
    lines = (hashed_lines(docs) if lines is None else lines).filter("n > 0")
    first = F.min(F.struct("doc_id", "line_no", "row")).alias("first")
    distinct = materialize(
        lines.groupBy("h1", "h2").agg(first, F.first("n").alias("n"), F.first("halves").alias("halves"), F.count("*").alias("lines")), "distinct-lines"
    )
    partnered, seen = measure(_with_partner(distinct.filter(F.col("n") >= min_words)), "partnered-lines", rows=F.count("*"))
    if seen["rows"] <= broadcast_rows:
        partnered = F.broadcast(partnered)
    # Firsts are unique, so this join meets no key twice, however often a line is repeated.
    worded = _exploded(docs).join(partnered, ["doc_id", "line_no", "row"]).dropDuplicates(["doc_id", "line_no", "row"])
    worded = materialize(worded.select(F.struct("doc_id", "line_no", "row").alias("first"), "words"), "line-words")
    keys = materialize(_keys(worded), "deletion-keys")
    pairs = _candidates(keys)
    ours, theirs = worded.select("first", "words"), worded.select(F.col("first").alias("other"), F.col("words").alias("other_words"))
    near = pairs.join(ours, "first").join(theirs, "other").filter(_one_edit(F.col("words"), F.col("other_words"))).select("first").distinct()
    marked = distinct.select("h1", "h2", "first", "lines").join(near.withColumn("near", F.lit(True)), "first", "left")
    doubtful = marked.filter("lines > 1 or near").select("h1", "h2", F.col("first.doc_id").alias("d"), F.col("first.line_no").alias("l"), "near")
    occurrences = lines.select("doc_id", "row", "line_no", "h1", "h2").join(doubtful, ["h1", "h2"])
    return occurrences.filter("near or doc_id <> d or line_no <> l").select("doc_id", "row", "line_no")


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, dropped)`` of every row; ``dropped`` are line numbers from 0, ascending."""
    per_doc = dropped_lines(docs, min_words).distinct().groupBy("doc_id", "row").agg(F.sort_array(F.collect_list("line_no")).alias("dropped"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"))
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    return rows.join(per_doc, ["doc_id", "row"], "left").select("doc_id", "n_lines", F.size(dropped).cast("long").alias("n_dropped"), dropped.alias("dropped"))


def deduplicate(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``.

    A document that lost lines is dropped as a whole if only blank lines are left. The other columns stay as they are; ``n_chars``, if there is one, is counted
    anew where lines were taken out.
    """
    with passing() as keep:
        found = materialize(dropped_lines(docs, min_words, lines=hashed_lines(docs)).distinct(), "dropped-lines")
        keep(found)
    per_doc = found.groupBy("doc_id", "row").agg(F.collect_list("line_no").alias("_dropped"))
    lines = F.split("text", "\n")
    keyed = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_row": F.xxhash64("text")})
    joined = keyed.join(per_doc.withColumnsRenamed({"doc_id": "_id", "row": "_row"}), ["_id", "_row"], "left")
    places = F.sort_array("_dropped")
    # Kept lines are the stretches between dropped ones: each dropped line ends one.
    starts = F.concat(F.array(F.lit(0)), F.transform(places, lambda k: k + 1))
    ends = F.concat(places, F.array(F.size(lines)))
    kept = F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a)))
    with_kept = joined.withColumn("_kept", F.when(F.col("_dropped").isNotNull(), kept))
    worth = F.exists("_kept", lambda line: F.size(_words(line)) > 0)
    changed = F.col("_dropped").isNotNull()
    out = with_kept.filter(~changed | worth)
    columns = []
    for name in docs.columns:
        value = F.col(name)
        if name == "text":
            value = F.when(changed, F.array_join("_kept", "\n")).otherwise(value)
        elif name == "n_chars":
            value = F.when(changed, F.length(F.array_join("_kept", "\n")).cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return out.select(*columns)
