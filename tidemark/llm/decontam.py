"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, names and units become typed placeholders, so a question asked anew with other values keeps its template.
Windows of five template words are hashed; a document's windows meet a benchmark's by hash. What the placeholders
stood for is compared along each run of windows: a window counts if its values became what they became in most windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a window, fewest of them that are no placeholders, and the share of an item's windows that makes a leak.
WINDOW, LITERAL, SHARE = 5, 3, 0.4
#: Words of an item found in one piece that make a leak at any share.
STRETCH = 13
#: Benchmark windows up to which their table is broadcast (some 60 MB); beyond that both sides are shuffled by hash.
BROADCAST_WINDOWS = 1_000_000

# A capital word behind a small letter, digit, comma or semicolon is a name; a unit follows a number.
NAME = r"(?<=[\p{Ll}\p{Nd},;]\x20)(?=\p{Lu}\p{Ll})"
MARK = "\ue000"
UNIT = "#u"
TOKEN = r"\x{E000}?[\p{L}\p{M}]+|[0-9]+(?:[.,][0-9]+)*|[$€£¥%°]"
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l gal s sec secs min mins h hr hrs ms day days week weeks month months year years "
    "second seconds minute minutes hour hours meter meters metre metres mile miles foot feet inch inches gram grams liter liters litre "
    "litres pound pounds dollar dollars euro euros cent cents percent degree degrees mph kmh kph w kw v a hz khz mhz ghz kb mb gb tb"
).split()


def _templates(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys``, ``windows``: an array of (at, hash, values behind placeholders) for every window of the text, and
    ``exact``: the windows with placeholders once more, hashed by the words themselves.

    A value is the word's original; behind a unit it is always ``UNIT``, since hour and hours are one unit.
    """
    named = rows.select(*keys, F.regexp_extract_all(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), NAME, MARK), F.lit(TOKEN), 0).alias("_raw"))
    number = lambda t: F.substring(t, 1, 1).between("0", "9")
    unit = lambda t, i: F.lower(t).isin(*UNITS) & F.coalesce(number(F.get(F.col("_raw"), i - 1)), F.lit(False))
    kind = lambda t, i: (
        F.when(number(t), F.lit("#n")).when(t.startswith(MARK), F.lit("#p")).when(t.isin("$", "€", "£", "¥", "%", "°") | unit(t, i), F.lit(UNIT))
    )
    # Texts without numbers, names and signs have no placeholder: the usual case is one lower().
    plain = ~F.exists("_raw", lambda t: t.rlike(r"^[0-9$€£¥%°\x{E000}]"))
    word = F.when(plain, F.transform("_raw", lambda t: F.lower(t))).otherwise(F.transform("_raw", lambda t, i: F.coalesce(kind(t, i), F.lower(t))))
    worded = named.select(*keys, "_raw", word.alias("_word"), plain.alias("_plain"))
    itself = F.transform("_raw", lambda t: F.xxhash64(F.lower(F.translate(t, MARK, ""))))
    hashed = worded.select(*keys, "_raw", "_word", "_plain", F.transform("_word", lambda w: F.xxhash64(w)).alias("_hash"), itself.alias("_itself"))
    part = lambda i: F.slice(F.col("_word"), i + 1, WINDOW)
    slot = lambda w: w.startswith("#")
    values = lambda i: F.transform(
        F.filter(F.arrays_zip(part(i).alias("w"), F.slice(F.col("_raw"), i + 1, WINDOW).alias("r")), lambda x: slot(x["w"])), lambda x: F.when(x["w"] == UNIT, x["w"]).otherwise(F.lower(x["r"]))
    )
    key = lambda i, of="_hash": F.xxhash64(*[F.get(F.col(of), i + k) for k in range(WINDOW)])
    no_values = F.lit(None).cast("array<string>")
    every = F.sequence(F.lit(0), F.size("_hash") - WINDOW)
    windows = F.when(F.size("_hash") < WINDOW, None).when(
        F.col("_plain"), F.transform(every, lambda i: F.struct(i.alias("at"), key(i).alias("hash"), no_values.alias("values")))
    ).otherwise(F.transform(every, lambda i: F.struct(i.alias("at"), key(i).alias("hash"), F.when(F.exists(part(i), slot), values(i)).alias("values"))))
    slotted = F.filter(every, lambda i: F.exists(part(i), slot))
    exact = F.when((F.size("_hash") >= WINDOW) & ~F.col("_plain"), F.transform(slotted, lambda i: F.struct(i.alias("at"), key(i, "_itself").alias("hash"), no_values.alias("values"))))
    return hashed.select(*keys, windows.alias("windows"), exact.alias("exact"))


def _exploded(templates: DataFrame, keys: list[str], windows: Column) -> DataFrame:
    """One row per window. The outer form keeps Spark from testing the array in a filter further down, where it would be computed anew."""
    return templates.select(*keys, F.explode_outer(windows).alias("w")).select(*keys, F.col("w.at").alias("at"), F.col("w.hash").alias("hash"), F.col("w.values").alias("values"))


def _wanted(benchmark: DataFrame) -> DataFrame:
    """The windows to look for. ``whole`` is empty for evidence; a text without any has its exact windows, and ``whole`` tells such texts apart."""
    text = benchmark["text"]
    # Numbers alone match nothing.
    items = benchmark.select(benchmark["item_id"], text.alias("_text"), F.md5(text.cast("binary")).alias("_id")).where("item_id IS NOT NULL")
    templates = _templates(items.where(F.col("_text").rlike(r"\p{L}")), ["item_id", "_id"], "_text")
    evidence = F.filter("windows", lambda w: WINDOW - F.coalesce(F.size(w["values"]), F.lit(0)) >= LITERAL)
    judged = templates.select("item_id", "_id", "exact", evidence.alias("evidence"))
    seen = F.size("evidence") > 0
    kept = judged.select("item_id", F.when(seen, F.lit("")).otherwise(F.col("_id")).alias("whole"), F.when(seen, F.col("evidence")).otherwise(F.col("exact")).alias("windows"))
    found = _exploded(kept, ["item_id", "whole"], F.col("windows")).where("hash IS NOT NULL")
    return found.select("item_id", "whole", F.col("at").alias("item_at"), "hash", F.col("values").alias("asked")).distinct()


def _stretch(at: Column) -> Column:
    """Words of the longest piece that windows at these places cover without a gap."""
    start = F.struct(F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"), F.lit(0).alias("best"))

    def further(state: Column, place: Column) -> Column:
        first = F.when(place <= state["last"] + WINDOW, state["first"]).otherwise(place)
        return F.struct(first.alias("first"), place.alias("last"), F.greatest(state["best"], place + WINDOW - first).alias("best"))

    return F.aggregate(F.array_sort(at), start, further, lambda state: state["best"])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``shared`` and ``windows`` of every document that holds a benchmark item, wholly or in part.

    ``shared`` of the item's ``windows`` distinct windows are found in the document, at least 40 % of them or 13 of the
    item's words in one piece, in runs
    of windows. In a run, windows do not count whose values became something else than in most windows with that value;
    if no outcome has more than half of them, none of them counts. Units may change freely. Windows with fewer than three words that are
    no placeholders are no evidence; an item without any must be found whole, word by word (in any case) and value by
    value, and matches nothing if it is all numbers. Items and documents of fewer than five words, empty or null, match nothing. Rows of
    one ``doc_id`` count as one document, rows of one ``item_id`` as one item; rows without ``doc_id`` are told apart by
    their text, items without id are ignored. Other columns are not read. Either table may be empty.
    """
    return _leaks(docs, benchmark).drop("_text_key")


def _text_key(doc_id: Column, text: Column) -> Column:
    """Tells rows without id apart."""
    return F.when(doc_id.isNull(), F.xxhash64(text))


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    keys = ["doc_id", "_text_key"]
    wanted = _wanted(benchmark)
    totals = wanted.groupBy("item_id", "whole").agg(F.countDistinct("hash").alias("windows"), F.count("*").alias("places"))
    count, whole = wanted.agg(F.count("*"), F.max("whole")).first()
    side = F.broadcast(wanted) if count <= BROADCAST_WINDOWS else wanted

    named = docs.select(docs["doc_id"], _text_key(docs["doc_id"], docs["text"]).alias("_text_key"), docs["text"].alias("_text"))
    # Exact windows only if an item needs them.
    windows = F.when(F.col("exact").isNull(), F.col("windows")).otherwise(F.concat("windows", "exact")) if whole else F.col("windows")
    met = _exploded(_templates(named, keys, "_text"), keys, windows).join(side, "hash").withColumn("run", F.col("at") - F.col("item_at"))
    runs = [*keys, "item_id", "whole", "run"]
    slots = F.arrays_zip(F.col("asked").alias("asked"), F.col("values").alias("given"))
    found = met.groupBy(*runs).agg(
        F.collect_set(F.struct("hash", "item_at", F.coalesce(slots, F.array()).alias("slots"))).alias("met"), F.flatten(F.collect_list(slots)).alias("slots")
    )
    # One value asked should always be one value given. Where it is not, what most windows say holds.
    pairs = F.array_distinct("slots")
    consistent = F.size(pairs) == F.size(F.array_distinct(F.transform(pairs, lambda s: s["asked"])))
    support = lambda same: F.size(F.filter("slots", same))
    held = F.filter(pairs, lambda s: 2 * support(lambda t: t == s) > support(lambda t: t["asked"] == s["asked"]))
    judged = found.select(*keys, "item_id", "whole", "met", F.when(~consistent, held).alias("held"))
    counted = F.when(F.col("held").isNull(), F.col("met")).otherwise(F.filter("met", lambda w: F.forall(w["slots"], lambda s: F.array_contains("held", s))))
    measured = judged.select(*keys, "item_id", "whole", counted.alias("counted"))
    measured = measured.withColumn("piece", _stretch(F.array_distinct("counted.item_at"))).withColumn("in_run", F.size("counted"))
    good = measured.select(*keys, "item_id", "whole", "piece", "in_run", F.explode("counted.hash").alias("hash"))
    shared = good.groupBy(*keys, "item_id", "whole").agg(F.countDistinct("hash").alias("shared"), F.max("piece").alias("piece"), F.max("in_run").alias("in_run"))
    enough = F.when(F.col("whole") == "", (F.col("shared") >= SHARE * F.col("windows")) | (F.col("piece") >= STRETCH)).otherwise(F.col("in_run") == F.col("places"))
    # One row per item.
    held = shared.join(totals, ["item_id", "whole"]).where(enough).groupBy(*keys, "item_id").agg(F.max(F.struct("shared", "windows")).alias("most"))
    return held.select(*keys, "item_id", "most.shared", "most.windows")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with their own columns only."""
    found = _leaks(docs, benchmark).select(F.col("doc_id").alias("_leak_id"), F.col("_text_key").alias("_leak_text")).distinct()
    same = docs["doc_id"].eqNullSafe(found["_leak_id"]) & _text_key(docs["doc_id"], docs["text"]).eqNullSafe(found["_leak_text"])
    return docs.join(found, same, "left_anti")
