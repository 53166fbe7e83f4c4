"""License scan (operator 4): template-markup matching.

A template is license wording with markup, in the manner of published license-list templates:

* plain words are mandatory and must match exactly (after lower-casing A-Z and word splitting);
* ``[[ ... ]]`` is an optional region (may nest);
* ``{{name:lo-hi}}`` is a replaceable region of lo to hi arbitrary words, ``{{name:lo-hi:regex}}`` of words that each
  match the regex entirely.

Every template compiles to a token automaton (states with word, replaceable-word and empty edges). A text is accepted
when some run of its words drives the automaton to its end, i.e. all mandatory wording is there, exactly and in order.
The scan starts an automaton only at words that can begin it, and every text is scanned whole.

Defined results: NULL and empty texts have 0 words, no positions, empty labels, score 0. Rows are independent:
repeated rows repeat their result, an empty table gives an empty result, extra columns pass through ``scan`` untouched
(its own columns take the names in ``RESULT``; an input column of such a name raises ``ValueError``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from kestrel.llm.common import ASCII_LOWER, map_rows, refuse_clash

# Word definition, base phrases and their labels.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license wording as templates, by label.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("gpl-notice", "licensed under the gnu general public license [[ version {{v:1-2:[0-9]+}} ]] [[ or any later version ]]"),
    ("gpl-header", "is free software [[ you can ]] redistribute it and or modify it under the terms of the gnu {{kind:0-2}} "
                   "general public license as published by the free software foundation [[ either ]] version {{v:1-2:[0-9]+}} "
                   "of the license [[ or at your option any later version ]]"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0-header", "licensed under the apache license version 2 0 the license you may not use this file except in "
                          "compliance with the license you may obtain a copy of the license at [[ {{url:1-8}} ]] unless "
                          "required by applicable law or agreed to in writing software distributed under the license is "
                          "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-family", "licensed under [[ a ]] cc by [[ {{terms:1-2:nc|nd|sa}} ]] {{v:1-2:[0-9]}} [[ international ]]"),
    ("cc-by-legal", "creative commons attribution [[ {{terms:1-3:noncommercial|sharealike|noderivatives|non|commercial|share|alike|no|derivatives}} ]] "
                    "{{v:1-2:[0-9]}} {{place:0-2}} [[ public ]] license"),
    ("mit-notice", "released under the mit license"),
    ("mit", "[[ the ]] mit license [[ mit ]] [[ copyright [[ c ]] {{holder:1-12}} ]] permission is hereby granted free of charge to "
            "any person obtaining a copy of this software and associated documentation files the software to deal in the software "
            "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and "
            "or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following "
            "conditions the above copyright notice and this permission notice [[ including the next paragraph ]] shall be included in "
            "all copies or substantial portions of the software"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this {{what:1-4}} and associated "
                  "documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met [[ 1 ]] redistributions of source code must retain the above copyright notice this list of "
            "conditions and the following disclaimer [[ 2 ]] redistributions in binary form must reproduce the above copyright notice "
            "this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc0-1.0", "cc0 [[ 1 0 ]] [[ universal ]] public domain dedication"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


# ---- template -> syntax tree -> token automaton -----------------------------------------------------------------
@dataclass(frozen=True)
class Gap:
    """A replaceable region of lo..hi words, each matching ``pattern`` (any word if None)."""

    lo: int
    hi: int
    pattern: str | None = None


def parse_template(markup: str) -> list:
    """Nested list of words (str), ``Gap`` and optional regions (list)."""
    root: list = []
    stack = [root]
    for tok in re.findall(r"\[\[|\]\]|\{\{.*?\}\}|[^\s]+", markup):
        if tok == "[[":
            inner: list = []
            stack[-1].append(inner)
            stack.append(inner)
        elif tok == "]]":
            if len(stack) == 1:
                raise ValueError("]] without [[")
            stack.pop()
        elif tok.startswith("{{"):
            m = re.fullmatch(r"\{\{\w+:(\d+)-(\d+)(?::(.+))?\}\}", tok)
            if not m or int(m[1]) > int(m[2]):
                raise ValueError(f"bad replaceable region {tok}")
            stack[-1].append(Gap(int(m[1]), int(m[2]), m[3]))
        else:
            if not re.fullmatch(LICENSE_WORD, tok):
                raise ValueError(f"not one lower-case word: {tok}")
            stack[-1].append(tok)
    if len(stack) != 1:
        raise ValueError("[[ without ]]")
    return root


@dataclass
class Automaton:
    """Token automaton: per state the word edges, the replaceable-word edges (pattern, target) and the closure of
    empty edges. State 0 starts, ``accept`` ends."""

    label: str
    words: list[dict[str, set[int]]] = field(default_factory=list)
    gaps: list[list[tuple[re.Pattern | None, int]]] = field(default_factory=list)
    empty: list[set[int]] = field(default_factory=list)
    accept: int = 0

    def state(self) -> int:
        self.words.append({})
        self.gaps.append([])
        self.empty.append(set())
        return len(self.words) - 1

    def build(self, node: list, at: int) -> int:
        for part in node:
            if isinstance(part, str):
                to = self.state()
                self.words[at].setdefault(part, set()).add(to)
                at = to
            elif isinstance(part, Gap):
                pattern = re.compile(part.pattern) if part.pattern else None
                end = self.state()
                for i in range(part.hi):
                    if i >= part.lo:
                        self.empty[at].add(end)
                    to = self.state()
                    self.gaps[at].append((pattern, to))
                    at = to
                self.empty[at].add(end)
                at = end
            else:
                end = self.build(part, at)
                self.empty[at].add(end)
                at = end
        return at

    def close(self) -> None:
        for s in range(len(self.empty)):
            seen, todo = {s}, [s]
            while todo:
                for t in self.empty[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            self.empty[s] = seen

    def first_words(self) -> set[str]:
        states = self.empty[0]
        if any(self.gaps[s] for s in states) or self.accept in states:
            raise ValueError(f"template {self.label} must begin with a mandatory or optional word")
        return {w for s in states for w in self.words[s]}

    def longest(self, words: list[str], start: int) -> int:
        """End of the longest accepted run from ``start``, or -1."""
        live, end, i = self.empty[0], -1, start
        while live:
            if self.accept in live:
                end = i
            if i == len(words):
                break
            w, after = words[i], set()
            for s in live:
                for t in self.words[s].get(w, ()):
                    after |= self.empty[t]
                for pattern, t in self.gaps[s]:
                    if pattern is None or pattern.fullmatch(w):
                        after |= self.empty[t]
            live, i = after, i + 1
        return end


def compile_template(label: str, markup: str) -> Automaton:
    a = Automaton(label)
    a.accept = a.build(parse_template(markup), a.state())
    a.close()
    a.first_words()
    return a


class Scanner:
    """All base phrases and automata, indexed by the words that can begin them."""

    def __init__(self, base: dict[str, str], templates):
        self.word = re.compile(LICENSE_WORD)
        self.base: dict[str, list[tuple[list[str], str]]] = {}
        for phrase, label in base.items():
            ws = phrase.split(" ")
            self.base.setdefault(ws[0], []).append((ws, label))
        self.automata: dict[str, list[Automaton]] = {}
        for label, markup in templates:
            a = compile_template(label, markup)
            for w in a.first_words():
                self.automata.setdefault(w, []).append(a)
        self.starts = set(self.base) | set(self.automata)

    def scan(self, text: str | None):
        words = self.word.findall((text or "").translate(ASCII_LOWER))
        places, base_labels, labels, spans = [], set(), set(), []
        starts = self.starts
        for i in [i for i, w in enumerate(words) if w in starts]:
            w = words[i]
            for ws, label in self.base.get(w, ()):
                if words[i : i + len(ws)] == ws:
                    places.append(i)
                    base_labels.add(label)
            for a in self.automata.get(w, ()):
                end = a.longest(words, i)
                if end >= 0:
                    labels.add(a.label)
                    spans.append({"label": a.label, "start": i, "end": end})
        score = 1.0 if labels else 0.5 if places else 0.0
        return (
            len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), score, spans,
        )


RESULT = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
    "score double, spans array<struct<label: string, start: bigint, `end`: bigint>>"
)


def scan(df: DataFrame, text_col: str = "text", base: dict[str, str] = BASE, templates=TEMPLATES, keep=None) -> DataFrame:
    """The ``keep`` columns (default: every input column) plus the columns of ``RESULT``; ``spans`` lists (label, first word, word after the last) of
    every accepted template run (the longest one from each start word). score: 1 for an accepted template, 0.5 for
    base phrases alone, 0 for neither."""
    keep = df.columns if keep is None else list(keep)
    refuse_clash(keep, RESULT)

    def make():
        scanner = Scanner(base, templates)
        return lambda texts: list(zip(*[scanner.scan(t) for t in texts], strict=True))

    return map_rows(df, [text_col], keep, RESULT, make)


# ---- the same language as one regular expression, for the SQL check ------------------------------------------------
def template_regex(markup: str) -> str:
    """RE2 pattern over the words joined as ``" w1 w2 ... "`` (each followed by one space)."""

    def render(node) -> str:
        out = ""
        for part in node:
            if isinstance(part, str):
                out += part + " "
            elif isinstance(part, Gap):
                out += f"(?:(?:{part.pattern or '[^ ]+'}) ){{{part.lo},{part.hi}}}"
            else:
                out += f"(?:{render(part)})?"
        return out

    return " " + render(parse_template(markup))


def oracle_sql(base: dict[str, str] = BASE, templates=TEMPLATES) -> str:
    """DuckDB SQL for the query's digest columns over ``documents``."""
    places = []
    for phrase in base:
        ws = phrase.split(" ")
        cond = " and ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(ws))
        places.append(f"list_filter(range(1, len(w) - {len(ws) - 2}), lambda i: {cond})")
    base_case = ", ".join(f"case when len({p}) > 0 then '{lab}' end" for p, lab in zip(places, base.values(), strict=True))
    tmpl_case = ", ".join(f"case when regexp_matches(j, '{template_regex(m)}') then '{lab}' end" for lab, m in templates)
    return f"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents),
found as (
  select doc_id, len(w) as n_words, {' || '.join(places)} as p,
         list_filter([{base_case}], lambda x: x is not null) as b,
         ' ' || array_to_string(w, ' ') || ' ' as j
  from words),
labelled as (
  select *, list_filter([{tmpl_case}], lambda x: x is not null) as t from found)
select doc_id, n_words::bigint as n_words, len(p)::bigint as n_base, list_min(p) - 1 as first_word, list_max(p) - 1 as last_word,
       coalesce(array_to_string(list_sort(list_distinct(b)), ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(b || t)), ','), '') as labels,
       case when len(t) > 0 then 1.0 when len(p) > 0 then 0.5 else 0.0 end::double as score
from labelled"""
