from __future__ import annotations

import posixpath

from pyspark.sql import functions as F

from silexa.functions import arrays, symbols, text
from silexa.functions.pywords import blank_count, folded, terms

ODD = ["", " ", "a b", "a b\u0085c", "x\x1cy", "one\r\ntwo\n\nthree\n", "a b\x0bc", None, "w" * 5000, "　lead and trail　", "a\n"]


def _column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in rows.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_words_and_lines_are_those_of_python(spark):
    assert _column(spark, ODD, text.word_count) == [len((v or "").split()) for v in ODD] == [blank_count(v) for v in ODD]
    assert _column(spark, ODD, text.words) == [(v or "").split() for v in ODD]
    assert _column(spark, ODD, text.lines) == [(v or "").splitlines() for v in ODD]


def test_python_terms():
    assert terms("The A_b-C d1!") == ["the", "a_b", "c", "d1"] and terms(None) == []
    assert folded("Ｆｕｌｌ­ ﬁt​X") == "full fitx" and folded(None) == ""


def test_names_and_breadcrumbs(spark):
    assert _column(spark, ["A > B", "", None, " > x"], text.headings) == [["A", "B"], [], [], ["x"]]
    rows = spark.createDataFrame([("A", "t"), ("", "t"), (None, "t")], "p string, t string")
    assert [r[0] for r in rows.select(text.with_breadcrumb(F.col("p"), F.col("t"))).collect()] == ["A\n\nt", "t", "t"]
    assert _column(spark, [r"I2C\_A\%\&", " x "], text.unescaped) == ["I2C_A%&", "x"]
    assert _column(spark, ["CHIP-a_B"], text.squashed) == ["chipab"]
    assert _column(spark, ["a  b \n \n\n\n c  "], text.tidy) == ["a b\n\nc"]
    assert _column(spark, ["a \n  b"], text.one_line) == ["a b"]
    assert _column(spark, [["a", "", None, "b"]], text.paragraphs, "array<string>") == ["a\n\nb"]
    titles = spark.createDataFrame([("H > x", "t", "p/a.md"), (" ", "first\nsecond", "p/a.md"), (None, "", "p/a.b.md"), (None, None, None)], "s string, t string, f string")
    assert [r[0] for r in titles.select(text.source_title(F.col("s"), F.col("t"), F.col("f"))).collect()] == ["H", "first", "a.b", None]
    url = "https://host/o/r"
    assert _column(spark, [f"{url}/blob/v1/a/b.c#L1", f"{url}/tree/m/d/", "https://other/blob/v/x"], lambda c: text.repository_path(c, url)) == ["a/b.c", "d", ""]
    assert _column(spark, [r"\section{A $x$} b \label{c} 100\%", None], text.latex_words) == [3, 0]


def test_document_names_are_those_of_posixpath(spark):
    links = ["../security/x#y", "./a", "b/../c", "../../d", "https://x/y", "mailto:a", "", "/abs/p", "x//y"]
    want = ["" if not p or p.startswith(("http", "mailto")) else posixpath.normpath(posixpath.join("api/ref", p)).lstrip("./") for p in (u.split("#")[0] for u in links)]
    assert _column(spark, links, lambda c: text.document_name(c, F.lit("api/ref"))) == want
    assert _column(spark, ["/a/b/", "x"], lambda c: text.document_name(c, F.lit(""))) == ["a/b", "x"]


def test_lists(spark):
    rows = spark.createDataFrame([(["b", "a", "b"], ["c", "a", None]), (None, None)], "x array<string>, y array<string>")
    assert [r[0] for r in rows.select(arrays.ordered_union(F.col("x"), F.col("y"))).collect()] == [["b", "a", "c"], []]
    assert [r[0] for r in rows.select(arrays.contains_all(F.col("x"), F.col("y"))).collect()] == [False, True]
    lists = spark.createDataFrame([(1, 2, ["b", "a"]), (1, 1, ["c", "b"]), (1, 3, None), (2, 1, [])], "k int, o int, v array<string>")
    assert {r["k"]: r["v"] for r in arrays.in_order_union(lists, ["k"], ["v"], "o").collect()} == {1: ["c", "b", "a"]}


def test_symbols(spark):
    names = ["CHn_CONF (n: 0-2)", "X (n: 0-2)", "A_n (n: 5-1)", "big_n (n: 0~64)", " plain ", "unknown", "", None, "n_n (n:0-1)"]
    want = [["CHn_CONF", "CH0_CONF", "CH1_CONF", "CH2_CONF"], ["X"], ["A_n"], ["big_n"], ["plain"], [], [], [], ["n_n", "0_n", "1_n"]]
    assert _column(spark, names, symbols.register_symbols) == want
    from silexa.sources.latex import register_symbols as again

    assert [again(n) for n in names if n] == [w for n, w in zip(names, want) if n]
    assert _column(spark, ["Register A_B (n: 0-1) at address 1 Register A_B at address Register C at address", None], symbols.documented_registers) == [["A_B", "C"], []]
    assert _column(spark, [["EN_BIT", "RESERVED", "ch_sel", "EN_BIT", "ABC"], None], symbols.field_symbols, "array<string>") == [["EN_BIT"], []]
    bits = spark.createDataFrame([("2", "4"), ("1", "3"), ("x", "3"), (None, "1")], "w string, p string")
    assert [r[0] for r in bits.select(symbols.bit_range(F.col("w"), F.col("p"))).collect()] == ["[5:4]", "[3]", "", ""]
    assert _column(spark, ["/*---- COMMON CAPS ----*/", "/** Group: x */", "int a; /* b */", "/* --- */", "/* " + "w " * 13 + "*/"], symbols.banner_title) == ["COMMON CAPS", "Group: x", None, None, None]
    assert _column(spark, ['#include "a.h"', " # include <b/c.h>", "x"], symbols.include_of) == ["a.h", "b/c.h", ""]
    refs = spark.createDataFrame([(["foo()"],), (["foo"],), (["Foo"],), (None,), ([None],)], "r array<string>")
    assert [r[0] for r in refs.select(symbols.mentions(F.col("r"), F.lit(" foo() "))).collect()] == [True, True, False, False, False]
    assert _column(spark, ["a/c2/x.h", "a/x.h"], lambda c: symbols.chips_of_path(c, ["c2", "c1"])) == [["c2"], ["c1", "c2"]]
    assert _column(spark, ["a/hw1/x.h", "a/x.h"], lambda c: symbols.revisions_of_path(c, {"hw1": ["r1"]})) == [["r1"], []]


def test_revision_scope(spark):
    rows = [("trm", [], ["a"]), ("idf", [], ["a"]), ("trm", ["b", "a"], ["a", "b"]), ("src", ["a"], ["a", "b"]), ("trm", ["a"], None), ("trm", None, None)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d string, r array<string>, p array<string>")
    got = [r[0] for r in frame.orderBy("i").select(symbols.revision_scope(F.col("d"), F.col("r"), F.col("p"))).collect()]
    only = "ONLY revision a -- does not apply to other silicon revisions"
    assert got == ["unknown revision coverage", None, "all published revisions (a, b)", only, only, "unknown revision coverage"]
