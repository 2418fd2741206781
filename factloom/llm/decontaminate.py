"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Words become a template: numbers, names and units turn into typed placeholders,
other words lose case and marks. Windows of template words are hashed and the
documents' windows joined with the benchmark's; so are windows of the plain
lower-case words, exactly. What matches along one
alignment of a document and an item is then checked slot by slot: each value of
the item must stand for one value of the document, and the other way round.
So a question with new numbers or names is caught, and chance matches of
placeholders are not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, small_or_shuffled, text_of

NAME, NUMBER, UNIT = "\u0001", "\u0002", "\u0003"

# Number words and units.
NUMBER_WORDS = "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
UNITS = "mm cm m km inch inches foot feet yard yards mile miles g kg mg gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres mph kmh watt watts volt volts"


#: Letters of scripts that put no spaces between words: each counts as a word.
UNSPACED = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]"


def spaced(text: Column) -> Column:
    """The text with each letter of a script without spaces as a word of its own."""
    wide = (F.octet_length(text) > F.char_length(text)) & text.rlike(UNSPACED)  # not in ASCII: a quick look saves most searches
    return F.when(wide, F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)


def marked(text: Column) -> Column:
    """The text in lower case, names and digit numbers as placeholders, other words without their marks."""
    t = F.regexp_replace(text, r"\p{Lu}(?<=[\p{L}\p{N},;'\x22)]\s\p{Lu})\S*", NAME)
    t = F.when(text.rlike(r"[0-9]"), F.regexp_replace(t, r"[^\p{L}\p{N}\s]{0,3}(?<!\S[^\p{L}\p{N}\s]{0,3})[0-9][0-9.,:/]*[^\s0-9]{0,4}(?!\S)", NUMBER)).otherwise(t)
    return F.lower(F.regexp_replace(t, r"[^\p{L}\p{N}\x01-\x03\s]+", ""))


def bare_words(text: Column) -> Column:
    """The text in lower case without marks, but for single ones between digits; its words are in step with those of ``marked``."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}\x01-\x03\s](?!(?<=[0-9].)[0-9])", ""))


def typed(words: Column) -> Column:
    """Template words: number words, and units behind a number, become placeholders too."""
    numbers, units = NUMBER_WORDS.split(), UNITS.split()

    def one(word: Column, at: Column) -> Column:
        before = F.get(words, at - 1)
        unit = word.isin(units) & ((before == NUMBER) | before.isin(numbers))
        return F.when(word.isin(numbers), NUMBER).when(unit, UNIT).otherwise(word)

    return F.transform(words, one)


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _starts(words: Column, width: int) -> Column:
    """Where windows start."""
    last = F.size(words) - width
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _window_hash(hashes: Column, at: Column, width: int) -> Column:
    return F.xxhash64(F.lit(width), *[F.get(hashes, at + k) for k in range(width)])


def _aligned(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _t, _r, _e): template words, raw words and bare words, without words of marks alone."""
    df = df.select(F.col(id_col).alias("_id"), spaced(text_of(text_col)).alias("_text"))
    text = F.col("_text")
    # marked() empties words of marks alone, and the split swallows their places: so they go from the raw text too.
    raw = F.regexp_replace(text, r"(?<!\S)[^\p{L}\p{N}\x01-\x03\s]+(?!\S)", "")
    both = df.select("_id", F.arrays_zip(F.split(marked(text), r"\s+").alias("t"), F.split(raw, r"\s+").alias("r"), F.split(bare_words(text), r"\s+").alias("e")).alias("_z"))
    kept = both.select("_id", F.filter("_z", lambda z: z["t"] != "").alias("_z"))
    words = kept.select("_id", F.col("_z.t").alias("_w"), F.col("_z.r").alias("_r"), F.col("_z.e").alias("_e"))
    return words.select("_id", typed(F.col("_w")).alias("_t"), "_r", "_e")


def _windows(aligned: DataFrame, width: int) -> DataFrame:
    """(_id, at, hash, exact, slots, width): a row for each window.

    ``hash`` is of the template words, ``exact`` of the bare words; slots are the
    values behind the placeholders.
    """
    bare = lambda w: F.lower(F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    words = F.transform(F.arrays_zip(F.col("_t").alias("kind"), F.col("_r").alias("value")), lambda z: F.struct(z["kind"].alias("kind"), F.when(z["kind"].isin(NAME, NUMBER, UNIT), bare(z["value"])).alias("value")))
    # No filter on the number of words here: pushed down, it would compute the words twice, and of all documents.
    ready = aligned.select("_id", _hashes(F.col("_t")).alias("_h"), _hashes(F.col("_e")).alias("_g"), words.alias("_z"))

    def window(at: Column) -> Column:
        near = F.array(*[F.get("_z", at + k) for k in range(width)])
        return F.struct(at.alias("at"), _window_hash(F.col("_h"), at, width).alias("hash"), _window_hash(F.col("_g"), at, width).alias("exact"), F.filter(near, lambda z: z["kind"].isin(NAME, NUMBER, UNIT)).alias("slots"))

    # The generator makes the windows, so that no row carries a document's words.
    rows = ready.select("_id", F.explode(F.transform(_starts(F.col("_h"), width), window)).alias("w"))
    return rows.select("_id", "w.at", "w.hash", "w.exact", "w.slots", F.lit(width).alias("width"))


def _keyed(windows: DataFrame, *more: str, by_template: Column, by_words: Column) -> DataFrame:
    """A row for each key of each window: the template hash (``loose``) and, where it differs or that is not used, the exact one."""
    loose = F.when(by_template, F.struct(F.col("hash").alias("key"), F.lit(True).alias("loose")))
    exact = F.when(by_words & ~(by_template & (F.col("hash") == F.col("exact"))), F.struct(F.col("exact").alias("key"), F.lit(False).alias("loose")))
    rows = windows.select("_id", "at", "slots", "width", *more, F.explode(F.array_compact(F.array(loose, exact))).alias("k"))
    return rows.select("_id", "at", "slots", "width", *more, "k.key", "k.loose")


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 8, run: int = 13, literals: int = 4, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Matches of documents with benchmark items: doc_id, item_id, words, first_word, kind.

    A match is an alignment of a document with an item on which at least ``run``
    template words agree in windows of ``width``, or all words of a shorter item,
    and whose slots are consistent. ``kind`` is ``verbatim`` if all slots hold the
    item's own values and ``reparameterised`` if not; ``first_word`` counts the
    document's words from 0. A pair is reported once, by its longest match.

    Windows match by their templates or, case and marks aside, by their very
    words. Templates with fewer than ``literals`` plain words (half the words, in
    items shorter than ``width``) say too little and are matched by the words
    alone; of an item that has too few other templates for ``run`` words, it is
    enough if all of them match. So the very words of an item are found whatever
    they are, an item of one word included. In scripts without spaces each letter
    is a word. A null or empty text matches nothing; texts are read whole; rows that repeat an id are matched as
    one document; rows with a null id are not reported. Other columns are not
    read. An empty table on either side gives an empty result.
    """
    items = settle(_aligned(benchmark.where(F.col(item_col).isNotNull()), item_col, item_text_col))
    # Windows are ``width`` words, but for items that have fewer.
    sizes = sorted(r[0] for r in items.select(F.least(F.size("_t"), F.lit(width)).alias("n")).where("n > 0").distinct().collect())
    keys = []
    for n in sizes:
        own = items.where(F.size("_t") >= width if n == width else F.size("_t") == n)
        mine = _windows(own, n).join(own.select("_id", F.size("_t").alias("words")), "_id")
        telling = n - F.size("slots") >= min(literals, (n + 1) // 2)
        kept = _keyed(mine, "words", by_template=telling, by_words=F.lit(True))
        kept = settle(kept.select(F.col("_id").alias("item"), F.col("at").alias("item_at"), F.col("key"), F.col("slots").alias("item_slots"), "words", "width", F.col("loose").alias("item_loose")).distinct())
        enough = kept.groupBy("item").agg(F.least(F.lit(run), F.first("words")).alias("needed"), F.least(F.lit(run), F.first("words"), F.count_distinct(F.when(F.col("item_loose"), F.col("item_at"))) + n - 1).alias("needed_loose"))
        keys.append(kept.join(enough, "item"))
    found = None
    if keys:
        kept = settle(reduce(DataFrame.unionByName, keys))
        values = F.aggregate("item_slots", F.lit(0), lambda n, s: n + 40 + F.length(F.coalesce(s["value"], F.lit(""))) * 4)
        count, size = kept.agg(F.count("*"), F.coalesce(F.sum(values + 120), F.lit(0))).first()
        hashes = kept.select(F.col("key").alias("hash")).distinct()
        split = lambda t: F.array_remove(F.split(t, r"\s+"), "")
        texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), spaced(text_of(text_col)).alias("_text"))
        words = texts.select("_id", split(marked(F.col("_text"))).alias("_w"), split(bare_words(F.col("_text"))).alias("_e"))
        hashed = words.select("_id", _hashes(typed(F.col("_w"))).alias("_h"), _hashes(F.col("_e")).alias("_g"))
        # A row for each place, not a transformed array: so the windows are hashed in generated code. Null keys match nothing.
        placed = hashed.select("_id", "_h", "_g", F.explode(_starts(F.col("_h"), sizes[0])).alias("at"))
        window = lambda side, n: F.when(F.col("at") <= F.size(side) - n, _window_hash(F.col(side), F.col("at"), n))
        seen = placed.select("_id", F.explode(F.array(*[window(side, n) for n in sizes for side in ("_h", "_g")])).alias("hash"))
        suspects = settle(seen.join(small_or_shuffled(hashes, count * 16), "hash", "left_semi").select("_id").distinct())
        near = docs.join(small_or_shuffled(suspects, suspects.count() * 16), docs[id_col] == suspects["_id"], "left_semi")
        near = settle(_aligned(near, id_col, text_col))
        theirs = reduce(DataFrame.unionByName, [_keyed(_windows(near, n), by_template=F.lit(True), by_words=F.lit(True)) for n in sizes])
        full = theirs.join(small_or_shuffled(kept, size), ["key", "width"])
        # Windows of equal words have equal values, whatever the case makes of them.
        values = F.when(F.col("loose") & F.col("item_loose"), F.col("slots")).otherwise(F.col("item_slots"))
        found = full.select(F.col("_id").alias("doc"), "item", (F.col("at") - F.col("item_at")).alias("shift"), "at", "words", "needed", "needed_loose", (F.col("loose") & F.col("item_loose")).alias("loose"), F.arrays_zip(F.col("item_slots").alias("i"), values.alias("d")).alias("z"))
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id {benchmark.schema[item_col].dataType.simpleString()}, words int, first_word int, kind string"
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    lines = found.groupBy("doc", "item", "shift", "words", "needed", "needed_loose").agg(
        F.count_distinct("at").alias("windows"), F.count_distinct(F.when(F.col("loose"), F.col("at"))).alias("loose"), F.min("at").alias("first"),
        F.array_distinct(F.flatten(F.collect_set("z"))).alias("z"), F.array_distinct(F.flatten(F.collect_set(F.when(F.col("loose"), F.col("z"))))).alias("z_loose"),
    )
    value = lambda z, side: F.array_distinct(F.transform(z, lambda s: F.struct(s[side]["kind"], s[side]["value"])))
    z = F.col("z")
    consistent = lambda z: (F.size(value(z, "i")) == F.size(z)) & (F.size(value(z, "d")) == F.size(z)) & ~F.exists(z, lambda s: s["i"]["kind"] != s["d"]["kind"])
    same = ~F.exists(z, lambda s: s["i"]["value"] != s["d"]["value"])
    size = F.when(F.col("words") >= width, F.col("windows") + width - 1).otherwise(F.col("words")).cast("int")
    # Windows matched by words alone must not undo what the templates tell.
    by_template = (F.col("loose") > 0) & ((F.col("words") < width) | (F.col("loose") + width - 1 >= F.col("needed_loose")))
    passed = lines.where((consistent(z) & (size >= F.col("needed"))) | (consistent(F.col("z_loose")) & by_template))
    best = passed.groupBy("doc", "item").agg(F.max_by(F.struct(size.alias("words"), F.col("first").alias("first_word"), F.when(same, "verbatim").otherwise("reparameterised").alias("kind")), F.struct(size, -F.col("first"), -F.col("shift"))).alias("m"))
    return best.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "m.words", "m.first_word", "m.kind")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without those that hold a benchmark item; rows with a null id stay."""
    bad = settle(contaminated(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("_bad")).distinct())
    return docs.join(small_or_shuffled(bad, bad.count() * 16), docs[id_col] == bad["_bad"], "left_anti")
