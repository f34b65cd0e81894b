"""Template decontamination against the same rules told plainly in Python."""

import collections
import re

import pytest
import regex

from tidemark.llm import template_decontam as op
from tidemark.llm.queries import QUERIES

DOCS = "doc_id long, text string, hash string, w string"
ITEMS = "item_id long, text string, n string"


SIGNS = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”‘’«»„…–—¿¡")


def words_of(text):
    out = []
    for w in re.split(r"[\x20\x09-\x0D]+", text or ""):
        while w and w[0] in SIGNS - set("+-"):
            w = w[1:]
        while w and w[-1] in SIGNS - set("%"):
            w = w[:-1]
        if set(w) - SIGNS:
            out.append(w)
    return out


def forms(words):
    out = []
    for w in words:
        if re.fullmatch(r"[+-]?[0-9][0-9.,:/-]*%?", w):
            out.append("<num>")
        elif regex.match(r"\p{Lu}\p{Ll}", w):
            out.append("<name>")
        else:
            out.append("<unit>" if out and out[-1] == "<num>" and w.lower() in op.UNITS else w.lower())
    return out


def all_forms(words):
    """(canonical words, the words behind each) of the three forms."""
    canon = forms(words)
    out = [(canon, [[w] for w in words]), (forms([w.lower() for w in words]), [[w] for w in words])]
    joined, behind = [], []
    for c, w in zip(canon, words):
        if c == "<name>" and joined and joined[-1] == "<name>" or c == "<unit>" and joined and joined[-1] == "<num>":
            behind[-1].append(w)
        else:
            joined.append(c)
            behind.append([w])
    return out + [(joined, behind)]


def plain(docs, items, window=op.WINDOW):
    """{(document id, item id)}: every row by itself."""
    wanted = {(i, t) for i, t in items}
    table, n, own = collections.defaultdict(list), collections.Counter(), {}
    for item in wanted:
        for form, (canon, behind) in enumerate(all_forms(words_of(item[1]))):
            own[item, form] = canon, behind
            for at in range(len(canon) - window + 1):
                if sum(not x.startswith("<") for x in canon[at:at + window]) >= op.LITERALS:
                    table[form, tuple(canon[at:at + window])].append((item, at))
                    n[item, form] += 1
    out = set()
    for d, t in docs:
        for form, (canon, behind) in enumerate(all_forms(words_of(t))):
            hits = collections.defaultdict(set)
            for p in range(len(canon) - window + 1):
                for item, at in table.get((form, tuple(canon[p:p + window])), ()):
                    hits[item, p - at].add(at)
            for (item, diagonal), ats in hits.items():
                if len(ats) < min(op.RUN, -(-n[item, form] // 2)):
                    continue
                slots, names = set(), set()
                item_canon, item_behind = own[item, form]
                for p in {p for a in ats for p in range(a, a + window)}:
                    if item_canon[p].startswith("<"):
                        pair = (" ".join(item_behind[p]).lower(), " ".join(behind[p + diagonal]).lower())
                        (names if item_canon[p] == "<name>" else slots).add(pair)
                free = [m for m in names if sum(o[0] == m[0] or o[1] == m[1] for o in names) == 1]
                if len({x for x, _ in slots}) == len(slots) == len({y for _, y in slots}) and 2 * len(free) >= len(names):
                    out.add((d, item[0]))
    return out


ITEM = ("If Alice walks 12 km in 3 hours and Bob walks 18 km in 5 hours then how far does the faster of the two "
        "walk in one day without any rest at all")
OTHER = "the quick brown fox jumps over the lazy dog and runs into the dark forest again"


@pytest.fixture(scope="module")
def cases():
    same = ITEM.replace("Alice", "Zoe").replace("12", "40").replace("Bob", "Max").replace("18", "55")
    uneven = ITEM.replace("12", "18")  # one value for two
    items = [(1, ITEM), (2, OTHER), (3, "too short to judge"), (4, None), (None, ITEM), (2, OTHER), (5, "")]
    docs = [(1, f"Some words before. {ITEM} and after"), (2, f"x {same} y"), (3, f"x {uneven} y"), (4, OTHER.upper() + "!!"),
            (5, "the quick brown fox sat"), (6, None), (7, ""), (8, "clean " * 30000), (None, OTHER), (9, OTHER), (9, OTHER),
            (10, " ".join(OTHER.split()[:9])), (11, "“" + ITEM.replace(" ", " \n ") + "”"), (12, "* - " + OTHER.replace(" ", " -- "))]
    return docs, items


def test_findings(spark, cases):
    docs, items = cases
    d = spark.createDataFrame([(i, t, "h", "w") for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, "n") for i, t in items], ITEMS)
    got = op.findings(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == plain(docs, items)
    by = {(r.doc_id, r.item_id): r for r in got}
    assert (1, None) in by and (11, None) in by  # an item without id is searched
    assert {(1, 1), (2, 1), (4, 2), (None, 2), (9, 2), (11, 1), (12, 2)} <= set(by) and (3, 1) not in by
    assert by[2, 1].reparameterised and not by[1, 1].reparameterised
    left = [r.doc_id for r in op.clean(d, b).collect()]
    assert None not in left and sorted(left) == [3, 5, 6, 7, 8, 10] and op.clean(d, b).columns == d.columns


def test_shuffled_benchmark(spark, cases, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_ROWS", 0)
    docs, items = cases
    d = spark.createDataFrame([(i, t, "h", "w") for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, "n") for i, t in items], ITEMS)
    assert {(r.doc_id, r.item_id) for r in op.findings(d, b).collect()} == plain(docs, items)


def test_query_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    expected = plain(docs, items)
    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_template_decontam"](spark, sf).collect()}
    assert got == expected and len(got) > 0


def test_words_and_forms(spark):
    texts = ["(Hello), 12.5% of 3 km -- 'tis U.S.A. -5 +7 x1 12km É ... end.", "", None, "a", " .. ", "—word—"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    from pyspark.sql import functions as F
    rows = df.select(op.plain_words(F.col("text")).alias("p")).withColumn("c", op.canonical(F.col("p"))).collect()
    for t, r in zip(texts, rows):
        assert r.p.split(" ") == (words_of(t) or [""])
        assert r.c.split(" ") == (forms(words_of(t)) or [""])


def test_empty(spark, cases):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, OTHER, "h", "w")], DOCS)
    assert op.findings(docs, items).collect() == [] and op.findings(some, items).collect() == []
    assert op.clean(some, items).count() == 1


def _found(spark, item, text):
    d = spark.createDataFrame([(1, text, "h", "w")], DOCS)
    return op.findings(d, spark.createDataFrame([(1, item, "n")], ITEMS)).collect()


def test_copies_in_other_case(spark):
    item = "The heat of one oven rose. It was then that a baker left. Is this what made the bread burn so fast"
    for text in (item.upper(), item.lower(), item):
        (row,) = _found(spark, item, "so " + text + " so")
        assert row.doc_place == 1 and not row.reparameterised


def test_longer_names_and_conflicts(spark):
    item = "we saw how the old boat of Alice went down the long river in 3 days"
    text = "Then Sir Knight said: " + item.replace("Alice", "Mary Ann Lee").replace("3 days", "3 weeks")
    (row,) = _found(spark, item, text)
    assert row.reparameterised and row.doc_place == 4
    item = "Any baker met Zoe and told Max that Eve had seen The big oven that was lit by Tom"
    (row,) = _found(spark, item, item.replace("Any baker", "The baker"))
    assert row.doc_place == 0
    assert _found(spark, ITEM, ITEM.replace("3 hours", "5 hours")) == []


def test_rows_are_judged_by_themselves(spark):
    clean = "nothing of any benchmark stands in this short and clean text at all"
    items = [(1, OTHER), (1, "a second and smaller text of the very same item that must be searched as well"), (None, ITEM)]
    docs = [(None, clean), (None, "x " + OTHER), (None, None), (5, clean), (5, "y " + ITEM),
            (6, "so a second and smaller text of the very same item that must be searched as well")]
    d = spark.createDataFrame([(i, t, "h", "w") for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, "n") for i, t in items], ITEMS)
    assert {(r.doc_id, r.item_id) for r in op.findings(d, b).collect()} == plain(docs, items) == {(None, 1), (5, None), (6, 1)}
    assert sorted(((r.doc_id, r.text) for r in op.clean(d, b).collect()), key=str) == sorted(
        [(None, clean), (None, None), (5, clean)], key=str)


def test_very_long_item(spark):
    item = " ".join(f"word{i % 997}x{i % 13}" for i in range(5000))
    (row,) = _found(spark, item, "before " + item[:20000] + " after")
    assert row.doc_place == 1 and row.item_windows > 4000
