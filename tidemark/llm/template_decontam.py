"""Benchmark decontamination by template canonicalisation. DataFrame and SQL only.

A text becomes words (runs without ASCII white space, outer signs stripped, none left: dropped), and each
word its canonical form: a number, a capitalised name or the unit after a number gives way to the
placeholder of its type, everything else is lower-cased. ``WINDOW`` consecutive canonical words are a template window.
As capitals also begin sentences and go in upper- or lower-cased copies, a text has a second form in which
no word is a name and all are lower-cased, and, as names differ in length and units may be left out, a third
one in which names that follow each other are one placeholder and a number with its unit is another.
Windows meet only windows of their form, and an item is found by any of them. The
windows of the benchmark items with at least ``LITERALS`` words that are no placeholder are joined by hash
with the windows of all documents; hits of one item in one document on one diagonal (document place less
item place) belong together, and an item is found where a diagonal has ``RUN`` of its windows, or half of
them if the item is shorter than that.

Slots. A re-parameterised question has other numbers, names or units in the same places. The values that
meet in the placeholders of the windows found must map one to one: the same value in the item always to
the same value in the document, and different ones to different ones. Where numbers or units do not, the
likeness is accidental and the finding is dropped. Of names, some of which are only sentence starts, half of
the pairs must be free of conflict; where they do and some value differs, the finding is marked
``reparameterised``.

Scale. The windows of the documents are not shuffled as long as the benchmark's fit ``BROADCAST_ROWS``,
which is counted first; a larger benchmark is joined by an ordinary shuffle. Only hits go on. The texts behind
them are read again, by the names of the documents with hits: as many of these are broadcast, more are joined.

Rows. Null texts are empty and match nothing; neither do items of fewer than ``WINDOW`` words. Rows are told
apart by id and text together, documents and items alike: every text of an id, and every text without id, is
judged by itself, and equal rows once. Extra columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import clash_free, let, stored

WINDOW = 8
LITERALS = 3
RUN = 6
BROADCAST_ROWS = 500_000
#: Units of measure, as words of their own.
UNITS = ("mm cm dm m km ft yd mi mile miles inch inches foot feet yard yards meter meters metre metres "
         "mg g kg lb lbs oz t ton tons tonne tonnes gram grams kilogram kilograms pound pounds ounce ounces "
         "ml cl l liter liters litre litres gallon gallons s sec min h hr hrs second seconds minute minutes hour "
         "hours day days week weeks month months year years cent cents dollar dollars euro euros usd eur gbp "
         "percent degree degrees mph kmh km/h").split()
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
#: The form with joined placeholders, and what stands between the words of one of them.
JOINED, GLUE = 2, "\x01"
_WS = r"[\x20\x09\x0A\x0B\x0C\x0D]"


#: The signs that are stripped from a word's ends.
SIGNS = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~“”‘’«»„…–—¿¡"""


def _class(without: str = "") -> str:
    """The signs as a character class of plain members: an intersection of classes would take several times as long."""
    return "[" + "".join(c if ord(c) > 127 else f"\\x{ord(c):02X}" for c in SIGNS if c not in without) + "]"


def plain_words(text: Column) -> Column:
    """Words without outer signs (a leading + or - and a trailing % stay), one space between them."""
    begin, end = f"{_class('+-')}*+", f"{_class('%')}*+"
    inner = F.regexp_replace(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")), end + _WS + "++" + begin, " ")
    # A word of signs alone leaves some of them, or a gap; one more pass closes it.
    return F.trim(F.regexp_replace(inner, rf" (?:{_class()}*+ )+", " "))


def _numbers(words: Column) -> Column:
    return F.regexp_replace(words, r"(?<![^ ])[+-]?[0-9][0-9.,:/-]*+%?(?![^ ])", NUM)


def _names(words: Column) -> Column:
    return F.regexp_replace(words, r"(?<![^ ])\p{Lu}\p{Ll}[^ ]*+", NAME)


def _units(words: Column) -> Column:
    """Words in lower case, a unit after a number replaced."""
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    return F.regexp_replace(F.lower(words), rf"{NUM} (?:{units})(?![^ ])", f"{NUM} {UNIT}")


def canonical(words: Column) -> Column:
    """The same words, as many, in canonical form; a unit counts as one after a number."""
    return _units(_names(_numbers(words)))


def forms(words: Column) -> Column:
    """The forms whose windows are looked for, by their number: canonical, without names, and ``JOINED``.
    The numbers are replaced once for all of them."""

    def joined(canon: Column) -> Column:
        return F.replace(F.regexp_replace(canon, f"{NAME}(?: {NAME})++", NAME), F.lit(f"{NUM} {UNIT}"), F.lit(NUM))

    return let(_numbers(words), lambda m: let(_units(_names(m)), lambda c: F.array(c, _units(m), joined(c))))


def _units_of(plain: Column, form: Column) -> Column:
    """The words that stand behind each canonical word of the form, as an array."""

    def glued(words: Column, canon: Column) -> Column:
        def end(i: Column) -> Column:
            here, after = F.get(canon, i), F.get(canon, i + 1)
            one = ((here == NAME) & (after == NAME)) | ((here == NUM) & (after == UNIT))
            return F.when(F.coalesce(one, F.lit(False)), GLUE).otherwise(" ")

        return F.split(F.array_join(F.transform(words, lambda w, i: F.concat(w, end(i))), ""), " ")

    words = F.split(plain, " ")
    return F.when(form == JOINED, let(words, lambda w: let(F.split(canonical(plain), " "), lambda c: glued(w, c)))).otherwise(words)


def _windows(rows: DataFrame, window: int, place: str, *keep: str) -> DataFrame:
    """``form, keep, place, hash``: a row for every window of the words ``canon``. Each word is hashed once; the numbers of
    a window's words stand beside each other as rows, so that they are hashed in generated code and not in a lambda."""
    rows = rows.select("form", *keep, F.transform(F.split("canon", " "), lambda w: F.xxhash64(w)).alias("_h"))
    n = F.greatest(F.size("_h") - window + 1, F.lit(0))
    beside = F.arrays_zip(*[F.slice("_h", k + 1, n).alias(f"w{k}") for k in range(window)])
    return rows.select("form", *keep, F.posexplode(beside).alias(place, "_w")).select(
        "form", *keep, place, F.xxhash64("form", "_w").alias("hash"))


def _is_slot(word: Column) -> Column:
    return word.isin(NUM, NAME, UNIT)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, form, at, hash, n`` of the windows with enough literal words; ``n``: their number in the
    item's form."""
    rows = _windows(items, window, "at", "item", "canon")
    literal = F.size(F.filter(F.slice(F.split("canon", " "), F.col("at") + 1, window), lambda x: ~_is_slot(x)))
    rows = rows.where(literal >= min(LITERALS, window)).select("item", "form", "at", "hash")
    return rows.join(rows.groupBy("item", "form").agg(F.count("*").alias("n")), ["item", "form"])


def _named(df: DataFrame, key: str, name: str) -> DataFrame:
    """``name, key, text``: a row's own name, never null, is its id and text together."""
    rows = clash_free(df, key, "text").select(F.col(key), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.select(_name_of(key).alias(name), key, "text")


def _name_of(key: str, text: str = "text") -> Column:
    """The id, or that it has none, and a digest of the text."""
    of = F.coalesce(F.concat(F.lit("="), F.col(f"`{key}`").cast("string")), F.lit("-"))
    return F.concat(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")), of)


def _prepared(rows: DataFrame, name: str) -> DataFrame:
    """``name, plain, form, canon``, a row for each form."""
    return rows.select(name, plain_words(F.col("text")).alias("plain")).select(
        name, "plain", F.posexplode(forms(F.col("plain"))).alias("form", "canon"))


def _few(rows: DataFrame) -> DataFrame:
    """Short stored rows, to be broadcast if they are counted to be at most ``BROADCAST_ROWS``."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _found(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """Findings by ``doc``, the name of a document's row, with both ids."""
    every = _named(benchmark, "item_id", "item").dropDuplicates(["item"])
    items = stored(_prepared(every, "item").join(every.select("item", "item_id"), "item"), "decon-items")
    wanted = _few(stored(item_windows(items, window), "decon-windows"))
    rows = _named(docs, "doc_id", "doc")
    grams = _windows(_prepared(rows, "doc"), window, "place", "doc").drop("form")
    hits = grams.join(wanted, "hash").groupBy("doc", "item", "form", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.max("n").alias("n"), F.collect_set("at").alias("ats"))  # an item bounds the set
    enough = F.least(F.lit(RUN), F.ceil(F.col("n") / 2))
    found = stored(hits.where(F.size("ats") >= enough), "decon-hits")
    # The values in the slots: from the texts of the few documents with hits, equal rows once.
    # Their names stored alone and counted: few of them go to the texts, which then need no shuffle; many are joined.
    hit = _few(stored(found.select("doc").distinct(), "decon-hit"))
    texts = stored(rows.join(hit, "doc", "left_semi").dropDuplicates(["doc"]).select(
        "doc", "doc_id", plain_words(F.col("text")).alias("plain")), "decon-texts")
    pairs = found.join(texts, "doc").select(
        *found.columns, "doc_id", _units_of(F.col("plain"), F.col("form")).alias("dw")).join(
        items.select("item", "item_id", "form", _units_of(F.col("plain"), F.col("form")).alias("iw"), F.split("canon", " ").alias("ic")),
        ["item", "form"])
    covered = F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + window - 1))))
    slots = F.filter(covered, lambda p: _is_slot(F.get("ic", p)) & F.get("dw", p + F.col("diagonal")).isNotNull())
    pairs = pairs.select("doc", "doc_id", "item", "item_id", "diagonal", "n", "ats", "dw", "iw", "ic").withColumn("met", F.array_distinct(
        F.transform(slots, lambda p: F.struct(
            F.lower(F.get("iw", p)).alias("i"), F.lower(F.get("dw", p + F.col("diagonal"))).alias("d"),
            (F.get("ic", p) == NAME).alias("name")))))

    def distinct(pairs: Column, side: str) -> Column:
        return F.size(F.array_distinct(F.transform(pairs, lambda m: m[side])))

    def one_to_one(pairs: Column) -> Column:
        return (F.size(pairs) == distinct(pairs, "i")) & (F.size(pairs) == distinct(pairs, "d"))

    def mostly(pairs: Column) -> Column:
        free = F.filter(pairs, lambda m: F.size(F.filter(pairs, lambda o: (o["i"] == m["i"]) | (o["d"] == m["d"]))) == 1)
        return 2 * F.size(free) >= F.size(pairs)

    consistent = let(F.filter("met", lambda m: ~m["name"]), one_to_one) & let(F.filter("met", lambda m: m["name"]), mostly)
    # The place in words: those of a joined placeholder count one by one.
    first = F.col("diagonal") + F.array_min("ats")
    kept = pairs.where(consistent).select(
        "doc", "doc_id", "item", "item_id", F.aggregate(F.slice("dw", 1, first), F.lit(0), lambda n, w: n + F.size(F.split(w, GLUE))).alias("doc_place"),
        F.size("ats").cast("long").alias("n_windows"), F.col("n").alias("item_windows"),
        F.exists("met", lambda m: m["i"] != m["d"]).alias("reparameterised"))
    best = F.max_by(F.struct("doc_place", "n_windows", "item_windows", "reparameterised"),
                    F.struct("n_windows", ~F.col("reparameterised"), -F.col("doc_place")))
    return kept.groupBy("doc", "doc_id", "item", "item_id").agg(best.alias("b")).select("doc", "doc_id", "item_id", "b.*")


def findings(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, item_id, doc_place, n_windows, item_windows, reparameterised``, a row for each item text found
    in a document's text (its best diagonal; ties: the first)."""
    return _found(docs, benchmark, window).drop("doc")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    leaked = _few(stored(_found(docs, benchmark, window).select(F.col("doc").alias("_leaked")).distinct(), "decon-ids"))
    return docs.join(leaked, _name_of("doc_id") == F.col("_leaked"), "left_anti")
