"""License scan: automata against regular expressions, base places, awkward texts, SQL."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import license_scan as L
from kestrel.llm.queries import op4_license_scan

MARKUPS = [
    "a b", "a [[ b ]] c", "[[ a ]] b", "a {{x:0-2}} c", "a {{x:1-2:b|c}} [[ a [[ b ]] ]] c", "a [[ {{x:1-3}} ]] a", "[[ a ]] [[ b ]] c {{x:2-2:a}}",
    "a [[ b ]] [[ b ]] b",
]


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(MARKUPS), st.lists(st.sampled_from("abc"), max_size=9))
def test_automaton_accepts_the_same_language_as_the_regex(markup, words):
    automaton = L.compile_template("t", markup)
    text = " " + " ".join(words) + " "
    pattern = re.compile(L.template_regex(markup))
    found = any(automaton.longest(words, i) >= 0 for i in range(len(words)))
    assert found == bool(pattern.search(text))
    for i in range(len(words)):  # the longest run from a start
        ends = [j for j in range(i, len(words) + 1) if re.fullmatch(L.template_regex(markup), " " + "".join(w + " " for w in words[i:j]))]
        assert automaton.longest(words, i) == max(ends, default=-1)


@pytest.mark.parametrize("markup", ["a [[ b", "a ]] b", "{{x:3-1}} a", "A b", "{{x:0-2}} a", "[[ a ]]", "a {{x}}"])
def test_bad_templates_are_refused(markup):
    with pytest.raises(ValueError):
        L.compile_template("t", markup)


TEXTS = [
    None, "", "...", "Licensed under the Apache License, Version 2.0.", "the MIT  License\nmit license", "apache apache license license",
    "This work is licensed under the GNU General Public License, version 3.", "gnu general public licence", "Licensed under CC BY-NC 4.0.",
    "Released under the MIT license. " * 40, "cc\tby cc by", "ÉCC BY", "cc by" + " x" * 30_000 + " Apache License",
    "MIT License Copyright (c) 2020 Some One Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files", "Licensed under the Apache License, Version 3.0", "licensed under cc by sa 4.0 international",
]


def test_known_texts(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, extra string").repartition(4)
    got = {r.doc_id: r for r in L.scan(df).collect()}
    assert len(got) == len(TEXTS) and all(r.extra == "x" for r in got.values())
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].labels, got[0].score) == (0, 0, None, "", 0.0)
    assert (got[3].labels, got[3].first_word, got[3].last_word, got[3].score) == ("apache,apache-2.0", 3, 3, 1.0)
    assert (got[4].n_base, got[4].first_word, got[4].last_word, got[4].base_labels, got[4].score) == (2, 1, 3, "mit", 0.5)
    assert got[5].n_base == 1 and got[5].first_word == 1
    assert got[6].labels == "gpl,gpl-notice" and got[7].labels == "" and got[8].labels == "cc-by,cc-by-family,cc-by-nc-4.0"
    assert got[9].n_base == 40 and got[10].n_base == 2 and got[11].n_base == 0
    assert got[12].n_words == 30_004 and got[12].n_base == 2 and got[12].last_word == 30_002
    assert "mit-grant" in got[13].labels and got[14].labels == "apache" and got[15].labels == "cc-by,cc-by-family"
    span = got[3].spans[0]
    assert (span.label, span.start, span.end) == ("apache-2.0", 0, 8)


def test_sql_and_query_agree(spark, tmp_path, oracle):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[4])], "doc_id long, text string")
    want = oracle(L.oracle_sql(), tmp_path, documents=df)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = [r.asDict() for r in op4_license_scan(spark, str(tmp_path)).collect()]
    key = lambda r: str(sorted(r.items()))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_empty_table_and_clash(spark):
    assert L.scan(spark.createDataFrame([], "text string")).count() == 0
    with pytest.raises(ValueError):
        L.scan(spark.createDataFrame([("a", "b")], "text string, labels string"))
