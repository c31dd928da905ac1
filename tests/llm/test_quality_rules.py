"""Quality rules against plain Python, and the threshold table as data."""

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tallyloom.llm.quality_rules import BASE, COUNTS, RULES, STOP_WORDS, Rule, judge_quality, rules_from

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_exclamations": text.count("!"),
        "n_capitals": sum("A" <= c <= "Z" for c in text),
        "n_stop_words": sum(w.lower() in STOP_WORDS for w in words),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_bullet_lines": sum(bool(re.match("[ \t]*[-*•]", x)) for x in lines),
        "n_open_lines": sum(bool(re.search("(\\.\\.\\.|…)[ \t\r]*$", x)) for x in lines),
        "n_repeat_words": len(repeated),
    }


def plain_failed(counts, rules):
    out = []
    for r in rules:
        part, whole = (counts[r.part], 1) if r.whole is None else (1000 * counts[r.part], counts[r.whole])
        if (r.at_least is not None and part < r.at_least * whole) or (r.at_most is not None and part > r.at_most * whole):
            out.append(r.name)
    return out


def check(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = sorted(judge_quality(docs, **options).collect(), key=lambda r: r.row.doc_id)
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_counts(texts[r.row.doc_id])
        assert {c: r[c] for c in COUNTS} == want
        assert list(r.failed) == plain_failed(want, [*BASE, *options.get("rules", RULES)])
        assert r.kept == (not r.failed)
        assert r.base_failed == bool(plain_failed(want, BASE))


def test_edge_texts(spark):
    prose = " ".join(f"word{i} the of" for i in range(40))
    texts = [
        None, "", " \t\n\x0b", "a", "a b", "a b c", "a a a", "a a a a a", "a b c a b c d", "x y z q x y z",
        prose, prose + "\n" + prose, "A!" * 200, prose + " ####" * 20, "- a\n* b\n• c\n...", "wait...\nwait… \r\nno",
        "same line\nsame line\n\nsame line\n  \n", "    ä \U0001f600", ("the cat sat on a mat " * 4000),
        " ".join(str(i) for i in range(30000)),
    ]
    check(spark, texts)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab \n#!.-A", max_size=120), min_size=20, max_size=40))
def test_random_texts(spark, texts):
    check(spark, texts)


def test_clashing_columns_repeated_rows_and_no_rows(spark, edge_docs, no_docs):
    out = judge_quality(edge_docs)
    assert out.count() == edge_docs.count()
    assert out.columns == ["row", *COUNTS, "base_failed", "failed", "kept"]
    assert set(out.schema["row"].dataType.names) == set(edge_docs.columns)
    assert judge_quality(no_docs).count() == 0


def test_rules_are_data(spark):
    table = spark.createDataFrame(
        [("short", "n_words", None, 3, None), ("marks", "n_exclamations", "n_words", None, 500)],
        "name string, part string, whole string, at_least int, at_most int",
    )
    rules = rules_from(table)
    assert [r.name for r in rules] == ["marks", "short"]
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b! c! d!"), (3, "a")], "doc_id int, text string")
    out = {r.row.doc_id: list(r.failed) for r in judge_quality(docs, rules=rules, base=()).collect()}
    assert out == {1: [], 2: ["marks"], 3: ["short"]}
    with pytest.raises(ValueError):
        judge_quality(docs, rules=[Rule("odd", "n_nothing", None, 1)])
    with pytest.raises(ValueError):
        judge_quality(docs, rules=[rules[0], rules[0]])


def test_plan_has_no_shuffle_and_no_python(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    plan = judge_quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow", plan)


def test_clean_documents_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = judge_quality(docs).select("row.doc_id", "n_words", "base_failed", "kept").join(labels, "doc_id")
    rows = judged.filter("not base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert not any(r.kept for r in rows if r.quality == 0)
