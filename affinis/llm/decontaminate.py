"""Benchmark decontamination by template canonicalisation, with DataFrame operations only.

Numbers, names and units become typed placeholders, so a question asked again with other values keeps its template. Hashes of
template windows of the benchmark are joined with those of all documents; where a document holds enough of an item's windows,
the values in its slots are compared with the item's where the windows around them lie: one item value must stand for one
document value throughout, unless enough windows hold the item's very words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.common import written

#: Words of a window; literal words that a benchmark window must have; share of an item's windows that makes a leak.
WINDOW, LITERALS, COVERAGE = 6, 3, 0.4
#: Consecutive windows, word for word, that make a leak of an item of any length: the share of an item of 60 words.
RUN = 22
#: Benchmark windows (of two numbers) that are broadcast at most; more are joined by shuffle, every document window with one of SALTS copies of them.
BROADCAST_ROWS, SALTS = 1_000_000, 16
#: Placeholders: private-use characters.
NAME, NUMBER, UNIT = "\ue001", "\ue002", "\ue003"
MARKS = f"{NAME}{NUMBER}{UNIT}"
#: Units after a number (fixed values).
UNITS = "mm|cm|m|km|in|inch|inches|ft|foot|feet|yd|yards?|miles?|mg|g|kg|tons?|tonnes?|oz|lbs?|pounds?|ml|cl|l|liters?|litres?|gallons?|s|sec|seconds?|min|minutes?|h|hr|hours?|days?|weeks?|months?|years?|mph|kmh|kph|hz|khz|mhz|ghz|w|kw|kwh|v|kb|mb|gb|tb|percent|dollars?|cents?|euros?|usd|eur|gbp"


def spaced(text: Column) -> Column:
    """The text with its numbers whole and apart from letters."""
    joined = F.regexp_replace(F.regexp_replace(text, r"(\p{N})[.,](\p{N})", "$1$2"), r"(\p{N})(\p{L})", "$1 $2")
    return F.when(text.rlike(r"\p{N}"), joined).otherwise(text)


def words(text: Column, kept: str = "") -> Column:
    """The lower-case words of a text: runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}{kept}]+", " ")), " "), "")


def template(text: Column) -> Column:
    """The words of a spaced text with placeholders; one for each word of words()."""
    named = F.regexp_replace(text, r"(?<=[\p{L}\p{N},;:] )\p{Lu}\p{Ll}+", NAME)
    with_units = F.regexp_replace(named, rf"(\p{{N}} +)(?i:{UNITS})\b", f"$1{UNIT}")
    return words(F.when(text.rlike(r"\p{N}"), F.regexp_replace(with_units, r"\p{N}+", NUMBER)).otherwise(named), MARKS)


def windows(source: DataFrame, keys: list[str], width: int) -> DataFrame:
    """keys, at (from 0) and hash of every window of ``width`` words of column ``template``."""
    hashed = source.select(*keys, F.transform("template", lambda w: F.xxhash64(w)).alias("h"))
    long = hashed.where(F.size("h") >= width)
    rolled = F.transform(F.sequence(F.lit(0), F.size("h") - width), lambda i: F.xxhash64(*(F.get("h", i + k) for k in range(width))))
    return long.select(*keys, F.posexplode(rolled).alias("at", "hash"))


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, item_words, template) of the benchmark."""
    text = spaced(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return benchmark.select(F.col(id_col).cast("long").alias("item_id"), words(text).alias("item_words"), template(text).alias("template")).distinct()


def line(words: Column) -> Column:
    """Words as one text with spaces around, in which a passage can be looked up."""
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def slot_shift(i: Column, width: int) -> Column:
    """From column ``placed``, how far word i of an item is moved in the document: as the windows over it are, those of the commonest
    shift first; without one, as the windows before and after it are, and null where these disagree."""
    over = F.filter("placed", lambda w: (w["item_at"] <= i) & (i < w["item_at"] + width))
    before = F.try_element_at(F.filter("placed", lambda w: w["item_at"] + width <= i), F.lit(-1))["shift"]
    after = F.get(F.filter("placed", lambda w: w["item_at"] > i), 0)["shift"]
    beside = F.when(F.coalesce(before, after) == F.coalesce(after, before), F.coalesce(before, after))
    return F.when(F.exists(over, lambda w: w["shift"] == F.col("shift")), F.col("shift")).otherwise(F.when(F.size(over) > 0, F.get(over, 0)["shift"]).otherwise(beside))


def hash_joined(rolled: DataFrame, known: DataFrame, small: bool) -> DataFrame:
    """Document windows with those of the benchmark by hash; in a shuffle the rows of one common window go to SALTS tasks."""
    if small:
        return rolled.join(F.broadcast(known), "hash")
    salted = rolled.withColumn("salt", F.pmod(F.col("text_key"), F.lit(SALTS)))
    return salted.join(known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["hash", "salt"]).drop("salt")


def texts_of(source: DataFrame, found: DataFrame, label: str) -> DataFrame:
    """The distinct rows of source whose text_key is in found: only their keys, a written table, meet all documents, and only their texts move on."""
    keys = written(found.select("text_key").distinct(), f"{label}-keys")
    return written(source.join(keys, "text_key", "left_semi"), label).distinct()


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, item_id, matched_windows, item_windows, coverage, n_slots, reparameterised): the benchmark items that documents hold.

    A pair is reported where at least ``coverage`` of the item's windows occur in the document and its slots are consistent, or
    so many occur word for word, or ``RUN`` consecutive ones do; reparameterised tells that slot values differ. Items of fewer
    than ``width`` words, or without a window of ``LITERALS`` literal words, are one window as a whole and searched word for word.
    Null and empty texts hold nothing; rows that share a doc_id, or have none, are searched text by text and give one row an item;
    items without words are not searched; of items with one id each is searched with the windows of all; empty tables give no rows; further
    columns are ignored; texts of any length are read whole.
    """
    items = benchmark_items(benchmark)
    places = F.when(F.size("template") >= width, F.sequence(F.lit(0), F.size("template") - width)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: F.size(F.filter(F.slice("template", i + 1, width), lambda w: ~w.rlike(f"[{MARKS}]"))) >= LITERALS)
    items = written(items.withColumn("starts", starts), "bench-items")
    item_windows = windows(items, ["item_id", "starts"], width).where(F.array_contains("starts", F.col("at"))).select("item_id", F.col("at").alias("item_at"), "hash").distinct()
    item_windows = written(item_windows, "bench-windows")
    sizes = item_windows.groupBy("item_id").agg(F.count("*").alias("item_windows"))
    small = item_windows.count() <= broadcast_rows
    marked = F.broadcast if small else (lambda df: df)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("text_key", F.xxhash64("text"))  # rows with one doc_id, or with none, stay apart by their texts
    rolled = windows(source.select("doc_id", "text_key", template(spaced(F.col("text"))).alias("template")), ["doc_id", "text_key"], width)
    placed = hash_joined(rolled, item_windows, small).groupBy("doc_id", "text_key", "item_id", "item_at").agg(F.min("at").alias("at"))
    found = placed.groupBy("doc_id", "text_key", "item_id").agg(
        F.count("*").alias("matched_windows"),
        F.mode(F.col("at") - F.col("item_at"), True).alias("shift"),
        F.array_sort(F.collect_list(F.struct("item_at", (F.col("at") - F.col("item_at")).alias("shift")))).alias("placed"),
    )
    found = found.join(marked(sizes), "item_id").where((F.col("matched_windows") >= coverage * F.col("item_windows")) | (F.col("matched_windows") >= RUN))
    found = written(found, "bench-found")
    texts = texts_of(source, found, "bench-texts").join(found.join(items, "item_id").withColumnsRenamed({"doc_id": "leak_id", "text_key": "leak_key"}), (F.col("text_key") == F.col("leak_key")) & F.col("doc_id").eqNullSafe(F.col("leak_id"))).select(
        "doc_id", "item_id", "matched_windows", "item_windows", "shift", "placed", "item_words", "starts", F.col("template").alias("item_template"), spaced(F.col("text")).alias("spaced")
    )
    both = texts.withColumns({"doc_words": words(F.col("spaced")), "doc_template": template(F.col("spaced"))})
    both = both.withColumn("line", line(F.col("doc_words")))
    # lambdas below are behind a second use of what they read, so that it is computed once a row
    same = F.transform("starts", lambda i: F.col("line").contains(line(F.slice("item_words", i + 1, width))))
    slots = F.filter(F.sequence(F.lit(0), F.size("item_words") - 1), lambda i: F.get("item_template", i).rlike(f"[{MARKS}]"))
    slots = F.transform(slots, lambda i: F.struct(i.alias("i"), (i + slot_shift(i, width)).cast("int").alias("at")))
    slots = F.filter(slots, lambda x: (x["at"] >= 0) & F.get("item_template", x["i"]).eqNullSafe(F.get("doc_template", x["at"])))
    pairs = both.withColumns({"same": F.when(F.length("line") > 0, same), "slots": F.when(F.size("doc_template") > 0, slots)})
    pairs = pairs.withColumn(
        "pairs", F.when(F.size("doc_words") > 0, F.transform("slots", lambda x: F.struct(F.get("item_words", x["i"]).alias("item"), F.get("doc_words", x["at"]).alias("doc"))))
    )
    consistent = F.size(F.array_distinct("pairs")) == F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"])))
    enough = F.col("matched_windows") >= coverage * F.col("item_windows")
    verbatim = F.size(F.filter("same", lambda x: x)) >= coverage * F.size("starts")
    runs = F.when(F.size("same") >= RUN, F.sequence(F.lit(1), F.size("same") - RUN + 1)).otherwise(F.array().cast("array<int>"))
    run = F.exists(runs, lambda k: F.forall(F.slice("same", k, RUN), lambda x: x))
    leaks = pairs.where((enough & (consistent | verbatim)) | run).groupBy("doc_id", "item_id", "matched_windows", "item_windows").agg(
        (F.first("matched_windows") / F.first("item_windows")).alias("coverage"),
        F.max(F.size("slots")).cast("long").alias("n_slots"),
        F.max(F.exists("pairs", lambda p: p["item"] != p["doc"])).alias("reparameterised"),
    )
    exact = items.where((F.size("starts") == 0) & (F.size("item_words") > 0)).select("item_id", "item_words", "template")
    # an item may be found by several texts: the row of most windows stays
    both = leaks if exact.isEmpty() else leaks.union(exact_leaks(source, exact, width, broadcast_rows))
    best = F.max_by(F.struct(*leaks.columns[2:]), F.struct("item_windows", "matched_windows", "n_slots", "reparameterised")).alias("best")
    return both.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def exact_leaks(source: DataFrame, items: DataFrame, width: int, broadcast_rows: int) -> DataFrame:
    """Rows like those of find_leaks for items that documents hold word for word: found by their first words, checked whole."""
    lengths = [r[0] for r in items.select(F.least(F.size("item_words"), F.lit(width))).distinct().collect()]
    anchors = items.select("item_id", F.least(F.size("item_words"), F.lit(width)).alias("n"), F.transform(F.slice("item_words", 1, width), lambda w: F.xxhash64(w)).alias("h"))
    keys = None
    for n in lengths:  # at most width of them
        own = anchors.where(F.col("n") == n).select("item_id", F.xxhash64(F.lit(n), *(F.get("h", k) for k in range(n))).alias("hash"))
        keys = own if keys is None else keys.union(own)
    keys = written(keys.distinct(), "bench-anchors")
    small = keys.count() <= broadcast_rows
    hashed = source.select("doc_id", "text_key", F.transform(words(spaced(F.col("text"))), lambda w: F.xxhash64(w)).alias("h"))

    def rolled(n: int) -> Column:
        places = F.when(F.size("h") >= n, F.sequence(F.lit(0), F.size("h") - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(F.lit(n), *(F.get("h", i + k) for k in range(n))))

    starts = hashed.select("doc_id", "text_key", F.explode(F.array_distinct(F.concat(*(rolled(n) for n in lengths)))).alias("hash"))
    found = hash_joined(starts, keys, small).select(F.col("doc_id").alias("leak_id"), "text_key", "item_id").distinct()
    found = written(found, "bench-anchored")
    wanted = found.join(items, "item_id").withColumnRenamed("text_key", "leak_key")
    texts = texts_of(source, found, "bench-anchored-texts").join(wanted, (F.col("text_key") == F.col("leak_key")) & F.col("doc_id").eqNullSafe(F.col("leak_id"))).select(
        "doc_id", "item_id", "template", line(F.col("item_words")).alias("item_line"), line(words(spaced(F.col("text")))).alias("line")
    )
    return texts.where(F.col("line").contains(F.col("item_line"))).groupBy("doc_id", "item_id").agg(
        F.lit(1).cast("long").alias("matched_windows"),
        F.lit(1).cast("long").alias("item_windows"),
        F.lit(1.0).alias("coverage"),
        F.max(F.size(F.filter("template", lambda w: w.rlike(f"[{MARKS}]")))).cast("long").alias("n_slots"),
        F.lit(False).alias("reparameterised"),
    )
