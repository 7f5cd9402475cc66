"""Hand-written cases of the text rules, and helpers against plain checkers."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.functions import glosses, markdown, parallel, strings, vectorized
from paperloom.operators import archive, chunking

rng = random.Random(1)


def one(spark, function, *texts):
    """The function's value for columns of literals."""
    return spark.range(1).select(function(*(F.lit(t) for t in texts)).alias("x")).first().x


CASES = [
    (markdown.unescape_brackets, r"see \(A, 2020\) and \\[B\] or \x", "see (A, 2020) and &#91;B&#93; or \\x"),
    (markdown.escape_orphan_dollars, "costs $200k\nand $x_1$ and $$a\nb$$ $", "costs \\$200k\nand $x_1$ and $$a\nb$$ \\$"),
    (markdown.escape_orphan_dollars, "from $5 to $9", "from $5 to $9"),
    (markdown.fix_heading_levels, "## 2.2.3 Deep\n#### 1. Top\n# Abstract\n## **3** Bold\n# 1.1.1.1.1.1.1 x", "#### 2.2.3 Deep\n## 1. Top\n# Abstract\n## **3** Bold\n###### 1.1.1.1.1.1.1 x"),
    (markdown.fix_heading_levels, '## <span id="a"></span>4.1 Spans\n##4 none\n# 7', '### <span id="a"></span>4.1 Spans\n##4 none\n# 7'),
    (markdown.merge_pseudocode, "text\n\n```\n1: a\n```\n\n2: b\n\n 3: c\nd\n\nend", "text\n\n```\n1: a\n2: b\n3: c\nd\n```\n\nend"),
    (markdown.merge_pseudocode, "```py\n1: a\n```", "```\npy\n1: a\n```"),
    (markdown.space_tables, "caption\n| a |\n|---|\n| b |\nnext\n\n| c |", "caption\n\n| a |\n|---|\n| b |\n\nnext\n\n| c |"),
    (markdown.space_anchors, '<span id="p1"></span>\n$$x$$\n<span id="p2"></span>\n\ny\n<span id="p3"></span>', '<span id="p1"></span>\n\n$$x$$\n<span id="p2"></span>\n\ny\n<span id="p3"></span>'),
    (markdown.space_equations, "a $$x$$ (2) b", "a \n\n$$x$$\n\n(2)\n\n b"),
    (markdown.space_equations, "$$x$$\n(12)\nrest", "$$x$$\n\n(12)\nrest"),
    (markdown.space_equations, "$$x$$", "$$x$$"),
    (vectorized.sanitize_math, "$\\begin{a}$ ok $x$", f"{vectorized.PLACEHOLDER} ok $x$"),
    (vectorized.sanitize_math, "$" + "M_r \\" * 20 + "$", vectorized.PLACEHOLDER),
    (vectorized.sanitize_math, "$" + "---" * 20 + "$", "$" + "---" * 20 + "$"),
    (strings.canonical_id, " http://x.org/abs/2608.00001v12 ", "2608.00001"),
    (strings.collapse_ws, " a\n\t b\u00a0\u3000c ", "a b c"),
    (strings.slugify, "--Deep, Learning: a (very) long title that goes on and on until it is cut off here", "deep-learning-a-very-long-title-that-goes-on-and-on-until-it"),
    (strings.truncate_title, "x" * 41, "x" * 40 + "…"),
    (strings.truncate_title, "y" * 39 + "  z", "y" * 39 + "…"),
    (strings.category_dir, "cs.CL", "nlp"),
    (strings.category_dir, "q-bio.NC", "q-bio_NC"),
    (glosses.dedup_glosses, "용어 (Term) 또 용어(term) 식 (1) 식 (1)\n# 제목 (Term)\n```\n용어 (Term)\n```\n저자 (Kim et al., 2024)", "용어 (Term) 또 용어 식 (1) 식 (1)\n# 제목 (Term)\n```\n용어 (Term)\n```\n저자 (Kim et al., 2024)"),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_text_rules(spark, k):
    function, text, want = CASES[k]
    assert one(spark, function, text) == want


def test_lines_at_once_equal_the_rules_in_turn(spark):
    parts = ["# 1.2 a", "## 3 b", "| a |", "| x | y |", "  | q |  ", "x", "", "  ", '<span id="q"></span>', ' <span id="r"></span> ', "#", "a | b", "###### 1.2.3.4.5.6 c", "\r", "|"]
    texts = ["\n".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(600)] + ["", None, "\n\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rules = markdown.space_anchors(markdown.space_tables(markdown.fix_heading_levels(F.col("t"))))
    for r in df.select("t", markdown.fix_lines(F.col("t")).alias("a"), rules.alias("b")).collect():
        assert r.a == r.b, r.t


def test_chain_equals_its_rules_on_all_documents(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("test tables are not here")
    from paperloom.plans.views import spark_view

    papers = spark_view(spark, "/root/testdata/sf0.001", "papers_md").unionByName(spark_view(spark, "/root/testdata/sf0.001", "tables"))
    c = F.col("md")
    for rule in (markdown.unescape_brackets, markdown.escape_orphan_dollars, markdown.merge_pseudocode, markdown.fix_heading_levels, markdown.space_tables, markdown.space_anchors, markdown.space_equations):
        c = rule(c)
    ruled = spark.createDataFrame(papers.select("doc_id", c.alias("md")).collect(), "doc_id long, md string")
    slow = ruled.withColumn("md", vectorized.sanitize_math("md")).collect()
    assert sorted(map(tuple, slow)) == sorted(map(tuple, markdown.clean_markdown(papers).collect()))


def test_titles(spark):
    title = lambda body: one(spark, archive.translated_title, body, "fallback")
    assert title("# **제목** <b> ## Abstract\nx") == "제목 <b>"
    assert title('# <span id="p"></span> T ###### x') == "T"
    assert title("## T") == title("#T") == title("# ** **") == "fallback"


def test_rules_that_change_nothing_twice(spark):
    texts = ["".join(rng.choices(["# 1.2 a\n", "| a |\n", "x\n", "\n", '<span id="q"></span>\n', "## 3 b\n"], k=12)) for _ in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for rule in (markdown.fix_heading_levels, markdown.space_tables, markdown.space_anchors):
        for r in df.select(rule(F.col("t")).alias("a")).select("a", rule(F.col("a")).alias("b")).collect():
            assert r.a == r.b


def test_newlines(spark):
    x = one(spark, markdown.fix_newlines, "a\\nb ```c\\nd``` $\\neq$")
    assert (x.text, x["count"]) == ("a\nb ```c\\nd``` $\neq$", 2)
    x = one(spark, lambda c: markdown.fix_newlines(c, protect_math=True), "a\\nb ```c\\nd``` $\\neq$")
    assert (x.text, x["count"]) == ("a\nb ```c\\nd``` $\\neq$", 1)


def test_pair_tests(spark):
    prose = "This is the long sentence of the paper that should have been translated and that reads like English prose of the usual kind, with many words in it."
    assert one(spark, parallel.is_refusal, "I’m sorry, but I can’t do it")
    assert one(spark, parallel.is_untranslated, prose, prose)
    assert not one(spark, parallel.is_untranslated, prose[:50], prose[:50])
    assert not one(spark, parallel.is_untranslated, f"- [3] {prose} (2020)", prose)
    assert not one(spark, parallel.is_untranslated, prose, "번역된 문장입니다 그리고 더 있습니다")
    assert one(spark, parallel.has_untranslated_run, prose, f"번역 {prose} 번역")
    assert not one(spark, parallel.has_untranslated_run, prose, f"번역 {prose} https://x.org 번역")
    names = ", ".join(f"Jane{k} Miller{k}" for k in range(20))
    assert not one(spark, parallel.has_untranslated_run, names, f"저자 {names} 끝")
    assert one(spark, parallel.brace_mismatch, "$a{b}$", "$a{b$") and not one(spark, parallel.brace_mismatch, "a{b $x$", "a $x$")
    assert one(spark, parallel.blank_marker, "# 제목\n (Blank  line) \nx") and not one(spark, parallel.blank_marker, "a (blank line)")
    assert one(spark, parallel.is_table, "| a | b |\n|:--|--:|\n| 1 |") and not one(spark, parallel.is_table, "| a |\n| b |")
    assert one(spark, parallel.is_reference, "- a (2020) (2021b) (1999)") and not one(spark, parallel.is_reference, "a (2020) (2021) (2022)")
    assert one(spark, parallel.fail_code, "짧다 $x$", "짧다 x") == "dollar_mismatch"
    assert one(spark, parallel.fail_code, "짧다", "abc" * 20) == "runaway_repetition"
    assert one(spark, parallel.fail_code, "짧다", "좋다") is None


def test_runaway_equals_the_pattern():
    slow = re.compile(r"(.{3,80}?)(?:\1){14,}")
    texts = ["", "abc" * 14, "abc" * 15, "--- " * 30, "\n".join(["abc"] * 30), "x" + "ab1" * 15 + "y", "가나다" * 15, "12 " * 44 + "a"]
    for _ in range(300):
        unit = "".join(rng.choices("ab-1 \n", k=rng.randint(1, 12)))
        texts.append("".join(rng.choices("ab- ", k=rng.randint(0, 60))) + unit * rng.randint(10, 30) + "".join(rng.choices("ab- ", k=rng.randint(0, 60))))
    for t in texts:
        assert vectorized.has_runaway(t) == any(re.search("[A-Za-z가-힣]", m[1]) for m in slow.finditer(t)), t


def test_chunks_keep_every_paragraph(spark):
    pieces = ["short", "x" * 30, "```\ncode", "more\n```", "| a |\n|---|\n| 1 |", "  ", "y" * 90]
    docs = [(k, "\n\n".join(rng.choices(pieces, k=rng.randint(0, 14)))) for k in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, md string")
    got = {}
    for r in sorted(chunking.chunk(df, 60).collect(), key=lambda r: (r.doc_id, r.batch_index, r.item_index)):
        got.setdefault(r.doc_id, {}).setdefault(r.batch_index, []).append(r)
    for k, md in docs:
        batches = got.get(k, {})
        items = [r.text for b in sorted(batches) for r in batches[b]]
        assert "\n\n".join(items).split("\n\n") == ([p for p in md.split("\n\n") if p.strip()] or [""])
        assert sorted(batches) == list(range(len(batches)))
        for b in batches.values():
            assert len(b) == 1 or (sum(len(r.text) + 7 for r in b) <= 60 and not any(r.is_table for r in b))
            assert [r.item_index for r in b] == list(range(len(b)))


def plain_paragraphs(text):
    """Paragraph after paragraph: one that leaves a fence open goes on with the next."""
    out, held = [], None
    for p in (p for p in text.split("\n\n") if p.strip()):
        held = p if held is None else f"{held}\n\n{p}"
        if held.count("```") % 2 == 0:
            out.append(held)
            held = None
    return out if held is None else [*out, held]


def test_fenced_paragraphs_equal_a_plain_walk(spark):
    parts = ["a", "```", "``", "\n\n", "\n", "\n\n\n", " ", "x y", "```py", "\t\n"]
    texts = ["", "```", "\n\n", "```\n\n\n\ncode\n\n \n\n", *("".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(400))]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, md string")
    got = {r.k: r.p for r in df.select("k", chunking.fenced_paragraphs(F.col("md")).alias("p")).collect()}
    for k, text in enumerate(texts):
        assert got[k] == plain_paragraphs(text), repr(text)


def test_batch_places():
    at = [(x >> 32, x & 0xFFFFFFFF) for x in vectorized.batch_places([5, 5, 3, 20, 1, 1, 9], [False, False, True, False, False, False, False], 10)]
    assert at == [(0, 0), (0, 1), (1, 0), (2, 0), (3, 0), (3, 1), (4, 0)]


def test_glosses_in_fences_and_headings_do_not_count(spark):
    from paperloom.operators.pair_quality import gloss_stats

    md = "말 (term)\n```\n글 (term)\n```\n# 제목 (term)\n  ```x``` 글 (term)\n글 (term)\n```\n글 (term) 글 (Other) 글 (other)"
    assert sorted((r.term, r.occurrences) for r in gloss_stats(spark.createDataFrame([(1, md)], "doc_id long, md string")).collect()) == [("Other", 2), ("term", 2)]
    md = "말 (Term) 글 (term)\n```\n글 (term)\n```\n글 (TERM)"
    assert [(r.term, r.occurrences, r.removed) for r in gloss_stats(spark.createDataFrame([(1, md)], "doc_id long, md string")).collect()] == [("Term", 3, 2)]


def test_probes_find_every_runaway():
    for _ in range(300):
        unit = "".join(rng.choices("ab-é", k=rng.randint(3, 80)))
        times = rng.choice([13, 14, 15, 16, 30])
        text = "".join(rng.choices("abcdé \n", k=rng.randint(0, 400))) + unit * times + "".join(rng.choices("abcdé \n", k=rng.randint(0, 400)))
        assert vectorized.may_run_away(text) >= (times >= 15), (unit, times)


def is_term(term: str) -> bool:
    return len(term) >= 2 and re.search("[a-zA-Z]", term) is not None and not re.search(r"(?i)(?:19|20)\d{2}[a-z]?|et al", term) and not set(term) & set("$\\`")


def plain_dedup(text: str) -> str:
    """Only the first gloss of a term stays, with its spelling; fences, headings, citations, math and code are left alone.

    The lines to leave alone are marked first; then all glosses of the text are met in order and the repeats cut out.
    """
    lines = text.split("\n")
    starts = np.cumsum([0, *(len(x) + 1 for x in lines[:-1])])
    heads = [x.lstrip()[:3] for x in lines]
    fence = np.array([h == "```" for h in heads])
    closed = fence | (np.cumsum(fence) % 2 == 1) | np.array([h.startswith("#") for h in heads])
    found = [m for m in re.finditer(r"(?<=[가-힣])( ?)\(([^()\n]{1,80})\)", text) if is_term(m[2].strip())]
    free = ~closed[np.searchsorted(starts, [m.start() for m in found], side="right") - 1] if found else ()
    met: set[str] = set()
    parts, done = [], 0
    for m, use in zip(found, free, strict=True):
        key = m[2].strip().lower()
        if use and key in met:
            parts.append(text[done : m.start()])
            done = m.end()
        elif use:
            met.add(key)
    return "".join([*parts, text[done:]])


def test_glosses_equal_a_plain_walk(spark):
    parts = ["용어", " (Term)", "(Term)", " (term )", "\n", "\n  # ", "\n```\n", "\n ```py\n", "(2024)", " (a`b)", " (x)", " (Word two)", "글 ", "a", " (et al)", "\r", " (word TWO)", ""]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(500)] + ["", None, "용어 (Term)" * 3000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", glosses.dedup_glosses(F.col("t")).alias("x"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for r in df.collect():
        assert r.x == (r.t if r.t is None else plain_dedup(r.t)), r.t
