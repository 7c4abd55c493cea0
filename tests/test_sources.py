from __future__ import annotations

import json
import subprocess

import pytest
from pyspark.sql import functions as F

from silexa.operators import store
from silexa.sources import files, headers, jsonl, latex, pages, provenance
from silexa.streaming import ingest

PAGE = """<document><section ids="t"><title>Timer</title>
  <paragraph>Call <literal classes="xref c">timer_start()</literal> before
   <reference internal="True" refuri="../sec/boot#x">boot</reference>, see <reference refuri="https://host/o/r/blob/v1/a/b.c">file</reference>.</paragraph>
  <target ids="hidden">HIDDEN</target>
  <literal_block xml:space="preserve">int a;
    int b;</literal_block>
  <table><title>Pins</title><tgroup><colspec/><thead><row><entry><paragraph>Pin</paragraph></entry><entry/></row></thead>
    <tbody><row><entry><paragraph>1</paragraph></entry><entry><paragraph>clock</paragraph></entry></row><row><entry/><entry/></row></tbody></tgroup></table>
  <desc><desc_signature><desc_name>run</desc_name><desc_parameterlist><desc_parameter>int a</desc_parameter><desc_parameter>int b</desc_parameter></desc_parameterlist></desc_signature></desc>
  <field_list><field><field_name>Returns</field_name><field_body><paragraph>OK on success</paragraph></field_body></field></field_list>
  <section ids="s"><title>Sub</title><paragraph>Inner <emphasis>text</emphasis> here.</paragraph><image alt="a picture"/></section>
  <section ids="indices-and-tables"><title>Nav</title><paragraph>skip me</paragraph></section>
</section></document>"""


def test_page():
    rows = pages.parse_page("api/timer.xml", PAGE.encode(), "https://host/o/r")
    assert len(rows) == 1
    text = rows[0]["text"]
    assert text.startswith("Timer\n\nCall timer_start() before boot, see file.") and "HIDDEN" not in text and "skip me" not in text
    assert "int a;\n    int b;" in text and "Pins\nPin: 1 | clock" in text and "run(int a, int b)" in text and "Returns: OK on success" in text
    assert "Sub\n\nInner text here." in text and "a picture" in text
    assert rows[0]["file_refs"] == ["a/b.c"] and rows[0]["doc_refs"] == ["sec/boot"] and rows[0]["symbol_refs"] == ["timer_start()", "run"] and rows[0]["file_path"] == "api/timer"


HEADER = """/*
 * SPDX-License-Identifier: X
 */
#ifndef A_H
#define A_H
#pragma once
#ifdef __cplusplus
extern "C" {
#endif
#include "y.h"
/* see old_name_t; #define GONE 1 */

/*------- CAPS -------*/
#define A_B 1 // tail
typedef enum {
    RED = 1, /*!< red */
    GREEN
} color_t;
typedef unsigned int word_t;
struct point { int x; };
int start(int x);
extern int counter;
// int commented(void);
#ifdef __cplusplus
}
#endif
#endif
"""


def test_header():
    rows = headers.parse_header("include/soc/a.h", HEADER.encode())
    symbols = [s for r in rows for s in r["symbol_refs"]]
    assert set(symbols) == {"A_B", "RED", "GREEN", "color_t", "word_t", "point", "start", "counter"} and rows[0]["file_refs"] == ["y.h"]
    text = rows[0]["text"]
    assert "SPDX" not in text and "cplusplus" not in text and "A_H" not in text and "CAPS" in text and "/*!< red */" in text
    card = headers.parse_card("register/a.h", b"/* Timer registers */\n" + "\n".join(f"#define R_{i} {i}" for i in range(2500)).encode())
    assert "Timer registers" in card[0]["text"] and "Declares 2500 symbols" in card[0]["text"]
    assert [s for r in card for s in r["symbol_refs"]] == [f"R_{i}" for i in range(2500)] and len(card) > 5


MAIN = r"""\documentclass{x}\def\mods{CHIP-A/01-x}
\begin{document}\chapter{One \& Two} Hello 100\% % a comment
\iffalse no \iftrue deep \fi \else yes \fi \tagged{CHIP-A}{mine}\untagged{CHIP-A}{theirs} \iftagged{B}{b}{c}
\subfile{\mods/regs} \input{missing} \subfile{\mods/regs}
\section{S} \begin{itemize}\item first \item[two] second\end{itemize}
\begin{longtable}{ll} A & B \\ \endfirsthead A & B \\ \endhead 1 & \textbf{2} \\ \end{longtable}
\begin{figure}\includegraphics{x.png}\caption{A picture}\end{figure}
\begin{verbatim}
raw \x{}
\end{verbatim}
\end{document}"""
REGS = r"""\begin{register}{H}{I2C\_CHn\_REG (n: 0-1)}{0x10}\regfield{EN\_BIT}{1}{3}{0}\regfieldrotate{MODE\_SEL}{2}{4}{1}\regfield{reserved}{1}{x}{0}
\begin{regdesc}\begin{reglist}\item[EN\_BIT] turns \emph{it} on. \item[(reserved)] x\end{reglist}\end{regdesc}\end{register}
\begin{register}{H}{PMP{n}CFG}{}\end{register}\subfile{CHIP-A/01-x__EN}"""


def test_latex():
    known = {"CHIP-A/01-x__EN.tex": MAIN, "CHIP-A/01-x/regs.tex": REGS}
    got = latex.resolve("CHIP-A/01-x__EN.tex", known, frozenset(["CHIP-A"]))
    assert got.files == ["CHIP-A/01-x__EN.tex", "CHIP-A/01-x/regs.tex", "CHIP-A/01-x/regs.tex"] and got.missing == ["missing"]
    rows = latex.parse_document("CHIP-A/01-x__EN.tex", known, frozenset(["CHIP-A"]))
    text = rows[0]["text"]
    assert text.startswith("One & Two\n\nHello 100%") and "comment" not in text and "yes mine c" in text and "deep" not in text and "theirs" not in text
    assert "Register I2C_CHn_REG (n: 0-1) at address 0x10" in text and "- EN_BIT [3] reset=0" in text and "- MODE_SEL [5:4] reset=1" in text and "- reserved  reset=0" in text
    assert "EN_BIT: turns it on." in text and "(reserved): x" not in text and "Register PMPnCFG\n" in text
    assert "- first" in text and "- two: second" in text and text.count("A | B") == 1 and "1 | 2" in text and "A picture" in text and "raw \\x{}" in text and "x.png" not in text
    assert rows[0]["symbol_refs"] == ["I2C_CHn_REG", "I2C_CH0_REG", "I2C_CH1_REG", "EN_BIT", "MODE_SEL", "PMPnCFG"]
    found = list(latex.registers_in(got.text))
    assert found[:2] == [("I2C_CHn_REG (n: 0-1)", "0x10", False), ("PMPnCFG", "", True)] and len(found) == 4
    assert latex.chosen_branches(r"a \iffalse b") == r"a \iffalse b" and latex.chosen_branches(r"\ifodd x \else y \fi") == r"\ifodd x \else y \fi"
    assert latex.expanded(r"\a", {"a": r"\b{} c", "b": r"\a"}).count("c") <= latex.MOST_EXPANSIONS and "strange" in latex.macros_used(r"\strange{x}")


def test_folders_of_files(spark, tmp_path):
    for name, content in {"p/api/timer.xml": PAGE, "p/bad.xml": "<document><x></document>", "p/other.xml": "<doxygen/>", "h/c/include/soc/a.h": HEADER, "h/c/register/soc/b.h": "#define B_REG 1\n", "h/c/src/x.h": "int no;", "l/CHIP-A/01-x__EN.tex": MAIN, "l/CHIP-A/01-x/regs.tex": REGS, "l/CHIP-A/CHIP-A-main.tex": "\\include{01-x__EN}", "l/00-shared/s.sty": "\\newcommand\\chipname{A}"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(content)
    got = pages.read_pages(spark, str(tmp_path / "p"), "https://host/o/r")
    assert [r["file_path"] for r in files.good(got).collect()] == ["api/timer"] and [r["file_path"] for r in files.failures(got).collect()] == ["bad.xml"]
    got = {r["file_path"]: r["symbol_refs"] for r in headers.read_headers(spark, str(tmp_path / "h")).collect()}
    assert set(got) == {"c/include/soc/a.h", "c/register/soc/b.h"} and got["c/register/soc/b.h"] == ["B_REG"]
    got = latex.read_manuals(spark, str(tmp_path / "l")).collect()
    assert [(r["file_path"], r["error"]) for r in got] == [("CHIP-A/01-x__EN", None)] and "mine c" in got[0]["text"]
    sources = spark.createDataFrame([("a.tex", "\\input{b} % \\input{c}\n\\subfile{d}")], "name string, text string")
    assert sorted(r["target"] for r in latex.include_edges(sources).collect()) == ["b", "d"]


def test_manuals_of_several_revisions(spark, tmp_path):
    chapter = r"\begin{document}\chapter{One}\section{Same} %s \section{Other} \iftagged{A-latest}{new}{old} \untagged{A-v1}{unless} \tagged{A-no}{never} \tagged{A}{mine} %s\end{document}".replace("%s", "word " * 300)
    for name, content in {"A/01-x__EN.tex": chapter, "A/A-main__EN.tex": r"\usetag{\chipseries}\usetag{A-latest, A-too} % \usetag{A-no}", "A/A-chip-revision-v1.3__EN.tex": r"\def\tag{A-v1}\usetag{\tag}", "B/01-y__EN.tex": chapter, "00-shared/s.sty": ""}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(content)
    read = latex.read_manuals(spark, str(tmp_path))
    by = {}
    for r in read.orderBy("position").collect():
        by.setdefault((r["chip"], *r["revisions"]), []).append(r["text"])
    told = {k: {w for w in ("new", "old", "unless", "never", "mine") if any(w in t.split() for t in v)} for k, v in by.items()}
    assert told == {("A", "mainline"): {"new", "unless", "mine"}, ("A", "v1.3"): {"old", "mine"}, ("B", "mainline"): {"old", "unless"}}
    once = latex.one_per_text(read).where("chip = 'A'").orderBy("first_seen").collect()
    assert sorted(r["revisions"] for r in once) == [["mainline"], ["mainline", "v1.3"], ["v1.3"]] and [r["first_revision"] for r in once if len(r["revisions"]) == 2] == ["mainline"]


def test_tags_of_a_file_reach_what_it_includes():
    known = {"A/01.tex": r"\usetag{t}\begin{document}\input{02}\end{document}", "A/02.tex": r"\tagged{t}{yes}\untagged{t}{no}"}
    assert latex.resolve("A/01.tex", known).text == "yes" and latex.resolve("A/02.tex", known).text == "no"


def test_grammar(spark):
    rows = [("b.tex", r"\begin{odd*}\strange{\emph{\odd x}} a\\strange \verb|\no| \section{S}\end{odd*}"), ("a.tex", "\\odd % \\no\n\\begin{verbatim}\\no\\end{verbatim}\\begin{register}\\end{register}")]
    got = {(r["kind"], r["name"]): (r["n"], r["example"], r["known"]) for r in latex.grammar(spark.createDataFrame(rows, "name string, text string")).collect()}
    assert got == {
        ("environment", "odd"): (1, "b.tex", False), ("environment", "verbatim"): (1, "a.tex", True), ("environment", "register"): (1, "a.tex", True), ("macro", "odd"): (2, "a.tex", False),
        ("macro", "strange"): (1, "b.tex", False), ("macro", "emph"): (1, "b.tex", False), ("macro", "verb"): (1, "b.tex", True), ("macro", "section"): (1, "b.tex", True),
    }


def test_jsonl_and_stream(spark, tmp_path):
    for k, rows in enumerate(([{"text": "b", "file_path": "p"}], [{"text": "a", "file_path": "p", "chips": []}, {"text": "b", "file_path": "p"}])):
        (tmp_path / f"{k}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows) + ("not json\n" if k else ""))
    got = jsonl.read_jsonl(spark, [str(tmp_path / "1.jsonl"), str(tmp_path / "0.jsonl")])
    assert [(r["file_ord"], r["text"]) for r in got.orderBy("file_ord", "line_ord").collect()] == [(0, "a"), (0, "b"), (0, None), (1, "b")]
    assert [r["bad_line"] for r in got.select("text", "bad_line").collect() if r["bad_line"]] == ["not json"]
    jsonl.write_jsonl(got.select("text", "file_path").where("text IS NOT NULL"), str(tmp_path / "out"), "text")
    assert [r["text"] for r in spark.read.json(str(tmp_path / "out")).orderBy("text").collect()] == ["a", "b", "b"]
    arriving = tmp_path / "in"
    arriving.mkdir()
    row = {"chunk_id": 1, "text": "t", "doc_type": "idf", "file_path": "p"}
    (arriving / "0.json").write_text(json.dumps(row) + "\n")
    for _ in range(2):
        ingest.stream_into_store(spark, str(arriving), str(tmp_path / "store"), str(tmp_path / "check")).awaitTermination(60)
        (arriving / "1.json").write_text(json.dumps(row) + "\n" + json.dumps(row | {"text": "u", "doc_type": "src"}) + "\n")
    assert sorted(r["text"] for r in store.read(spark, str(tmp_path / "store")).collect()) == ["t", "u"]


def test_streamed_windows_equal_the_batch(spark, tmp_path):
    events = spark.range(200).select((F.timestamp_seconds(F.col("id") * 97)).alias("ts"), (F.col("id") % 3).alias("k"))
    events.write.parquet(str(tmp_path / "e"))
    stream = ingest.windowed(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e")), "ts", ["k"], "1 hour", late="100 days")
    stream.writeStream.format("memory").queryName("streamed").outputMode("complete").trigger(availableNow=True).start().awaitTermination(60)
    assert sorted(map(tuple, spark.table("streamed").collect())) == sorted(map(tuple, ingest.windowed(events, "ts", ["k"], "1 hour").collect()))


def test_provenance(spark, tmp_path):
    assert provenance.revision_of(tmp_path) == provenance.Revision() == provenance.revision_of(tmp_path / "none")
    run = lambda *a: subprocess.run(["git", "-c", "user.name=a", "-c", "user.email=a@b", "-C", str(tmp_path), *a], check=True, capture_output=True)
    run("init")
    (tmp_path / "f").write_text("x")
    run("add", "f")
    run("commit", "-m", "m")
    run("tag", "v1")
    got = provenance.revision_of(tmp_path)
    assert got.version == "v1" and len(got.commit) == 40
    (tmp_path / "f").write_text("y")
    assert provenance.revision_of(str(tmp_path)).version == "v1-dirty"
    assert provenance.with_revision(spark.range(1), got).first()["source_version"] == "v1"
    assert provenance.first_existing(None, tmp_path / "none", tmp_path) == tmp_path
    with pytest.raises(FileNotFoundError):
        provenance.first_existing(tmp_path / "none")


def test_listings_are_read_as_they_are():
    source = r"""\begin{document}Use \verb|50%| of it. % gone \begin{verbatim}
\begin{lstlisting}[language=C]
printf("%d items", n); next(); \fi \tagged{X}{y} \reg
\end{lstlisting}
\iffalse \verb|\fi| no \fi See \href{http://u}{the page} and \url{u.v}.\end{document}"""
    rows = latex.parse_document("M/01-x.tex", {"M/01-x.tex": source}, frozenset(), {"reg": "REG"})
    text = "\n".join(r["text"] for r in rows)
    assert "Use 50% of it." in text and r'printf("%d items", n); next(); \fi \tagged{X}{y} \reg' in text
    assert "gone" not in text and " no" not in text and "See the page and u.v." in text and "http" not in text


def test_longtable_feet_and_cycles():
    table = r"""\begin{longtable}{ll}A & B \\ \endfirsthead A & B (continued) \\ \endhead \multicolumn{2}{r}{more} \\ \endfoot end \\ \endlastfoot 1 & 2 \\ 3 & 4 \\ \end{longtable}"""
    known = {"M/01-x.tex": table + r"\input{b}", "M/b.tex": r"\input{01-x} tail \tagged{a}{A \untagged{b}{B \iftagged{c}{C}{D}}}"}
    text = latex.parse_document("M/01-x.tex", known, frozenset(["a", "c"]))[0]["text"]
    assert "A | B\n1 | 2\n3 | 4" in text and "continued" not in text and "more" not in text and "end" not in text and "A B C" in text
    got = latex.resolve("M/01-x.tex", known)
    assert got.cycles == ["M/01-x.tex"] and got.missing == []


def test_header_forms():
    source = """#define MULTI(x) \\
    do_it(x)
typedef enum { ONE = (1 << 2), /* TWO, */ TWO,
  THREE } kind_t;
typedef struct __attribute__((packed)) tag { int inner; union { int a; } both; } tag_t;
static inline int twice(int x) { return x + helper(x); }
extern const char *const names[4];
typedef void (*callback)(int);
int *make(struct other *o, int n) __attribute__((weak));
const char *text = "int fake(void);";
#if defined(X)
enum kind2 { A_KIND };
#endif
/* --- Part two --- */
extern "C" {
void linked(void);
}
"""
    told = headers.scan(source)
    assert set().union(*told.names.values()) == {"MULTI", "ONE", "TWO", "THREE", "kind_t", "tag", "both", "tag_t", "names", "make", "kind2", "A_KIND", "linked"}
    assert list(told.banners.values()) == ["Part two"] and told.names[3] == {"THREE", "kind_t"}
    assert headers.parse_header("include/soc/e.h", b"") == [] and headers.banner("/* x */ int a;") is None
