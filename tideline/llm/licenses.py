"""Licence scans: Dice coefficient over word bigrams against licence templates.

A text's lines, and the text as a whole, are normalised (lower case, letters and digits only) and compared with each
template by the Dice coefficient of their sets of word bigrams. Size bounds prune first: with a bigrams on one side and b
on the other the coefficient is at most 2 min(a, b) / (a + b). With ``windows`` every run of words is compared too, over
the borders of lines and inside longer ones. Only DataFrame functions are used.
"""

from __future__ import annotations

import json
import math
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, once, staged, text_of

# Short notices as texts carry them. The first four are also the only ones that the test data has.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
    "the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
# Headers of source files, as the licences' own texts propose them.
HEADERS = (
    ("GPL-2.0", _GNU.format("General Public License", "2")),
    ("GPL-3.0", _GNU.format("General Public License", "3")),
    ("LGPL-2.1", _GNU.format("Lesser General Public License", "2.1")),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", "3")),
    ("AGPL-3.0", _GNU.format("Affero General Public License", "3")),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
)


def whole_texts() -> tuple[tuple[str, str], ...]:
    """The licence texts of the folder license_texts, named by their files."""
    folder = Path(__file__).parent / "license_texts"
    return tuple((p.stem, p.read_text(encoding="utf-8")) for p in sorted(folder.glob("*.txt")))


def all_templates() -> tuple[tuple[str, str], ...]:
    """Short notices, headers and whole texts."""
    return TEMPLATES + HEADERS + whole_texts()


#: Words that most texts have: taken for pruning only if nothing else is left.
COMMON = frozenset("with that this from your have will such other under which these they their shall must more than been were".split())


def words_of(text: Column) -> Column:
    """Normalised words: runs of letters and digits in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def bigrams_of(words: Column) -> Column:
    """The set of word bigrams; empty for fewer than two words."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1),
        lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)),
    )
    return F.when(F.size(words) >= 2, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class Template:
    place: int
    licence: str
    bigrams: tuple[str, ...]
    pairs: int  # word pairs with their repeats

    def low(self, least: float) -> int:
        """The bigrams that whatever reaches the coefficient shares at least."""
        return math.ceil(len(self.bigrams) * least / (2 - least) - 1e-9)

    def longest(self, least: float) -> int:
        """The word pairs that a window has at most."""
        return math.floor(self.pairs * (2 - least) / least + 1e-9)


def prepared(templates: tuple[tuple[str, str], ...]) -> list[Template]:
    out = []
    for i, (licence, text) in enumerate(templates):
        words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        pairs = list(map(" ".join, zip(words, words[1:])))
        out.append(Template(i, licence, tuple(dict.fromkeys(pairs)), len(pairs)))
    return out


def _needed_words(templates: list[Template], least: float) -> list[str]:
    """Words one of which occurs in whatever reaches the coefficient with some template.

    A match lacks at most a - low of a template's a bigrams, so it has one of any words that are in more bigrams than that.
    Words that are long and in many bigrams are taken first.
    """
    needed = set()
    for t in templates:
        left, spare = [set(b.split()) for b in t.bigrams], len(t.bigrams) - t.low(least)
        while len(t.bigrams) - len(left) <= spare and left:
            counts = Counter(w for b in left for w in b)
            word = max(counts, key=lambda w: (w in needed, len(w) > 3 and w not in COMMON, counts[w] * len(w), w))
            needed.add(word)
            left = [b for b in left if word not in b]
    return sorted(needed)


def _set_of(t: Template) -> Column:
    """The bigrams as one constant."""
    return F.split(F.lit("\n".join(t.bigrams)), "\n")


def _dice(grams: Column, t: Column, least: float) -> Column:
    """The coefficient of a set of bigrams with a row of :func:`_tables`; zero beyond the size bounds."""
    n = F.size(grams)
    shared = F.size(F.array_intersect(grams, t["g"]))
    return F.when(2 * F.least(n, t["a"]) / (n + t["a"]) >= least, 2 * shared / (n + t["a"])).otherwise(F.lit(0.0))


_START = 8  # pairs of words by which the start of a window is judged


def _tables(ready: list[Template], least: float) -> Column:
    """All templates as one constant array."""
    rows = []
    for t in ready:
        first = min(_START, t.low(least))
        rows.append(
            {
                "place": t.place, "a": len(t.bigrams), "low": t.low(least), "most": t.longest(least), "first": first,
                "dense": math.ceil(first * least / 2 - 1e-9), "name": t.licence, "g": t.bigrams,
            }
        )
    fields = "place int, a int, low int, most int, first int, dense int, name string, g array<string>"
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{fields}>>")


def _lookup(ready: list[Template]) -> Callable[[Column], Column]:
    """The places of the templates that have a bigram, from one constant: lists of bigrams by their crc32."""
    places: dict[str, list[int]] = {}
    for t in ready:
        for b in t.bigrams:
            places.setdefault(b, []).append(t.place)
    size = 1 << max(4, len(places).bit_length())
    rows: list[list[dict]] = [[] for _ in range(size)]
    for b, of in places.items():
        rows[zlib.crc32(b.encode()) % size].append({"b": b, "of": of})
    table = F.from_json(F.lit(json.dumps(rows)), "array<array<struct<b string, of array<int>>>>")

    def of(bigram: Column) -> Column:
        same = F.filter(F.get(table, F.pmod(F.crc32(bigram.cast("binary")), F.lit(size)).cast("int")), lambda e: e["b"] == bigram)
        return F.coalesce(F.get(same, F.lit(0))["of"], F.array().cast("array<int>"))

    return of


_CANDIDATE = "array<struct<less:int,minus:double,place:int,s:int,e:int>>"
def _candidates(tables: Column, least: float) -> Column:
    """The windows in a row (g, of, before, places, taken, whole): structs (-shared, -dice, place, first and last pair)."""

    def of_template(t: Column) -> Column:
        def of_marks(m: Column) -> Column:
            """``m``: for each pair where it stood before, and whether the template has it."""

            def taken(i: Column) -> Column:
                return F.exists("taken", lambda o: (o["s"] <= i) & (i <= o["e"]))

            def best_from(s: Column) -> Column:
                def step(acc: Column, x: Column) -> Column:
                    new = F.when(x["before"] < s, F.lit(1)).otherwise(F.lit(0))
                    d, n = acc["d"] + new, acc["m"] + F.when(x["hit"], new).otherwise(F.lit(0))
                    dice = 2 * n / (d + t["a"])
                    more = x["hit"] & (dice > acc["dice"])
                    return F.struct(
                        (acc["i"] + 1).alias("i"), d.alias("d"), n.alias("m"),
                        F.when(more, dice).otherwise(acc["dice"]).alias("dice"), F.when(more, acc["i"]).otherwise(acc["e"]).alias("e"),
                        F.when(more, n).otherwise(acc["shared"]).alias("shared"),
                    )

                zero = F.struct(s.alias("i"), F.lit(0).alias("d"), F.lit(0).alias("m"), F.lit(0.0).alias("dice"), s.alias("e"), F.lit(0).alias("shared"))
                end = F.coalesce(F.array_min(F.transform(F.filter("taken", lambda o: o["s"] > s), lambda o: o["s"])), F.size("g"))
                return F.aggregate(
                    F.slice(m, s + 1, F.least(t["most"], end - s)), zero, step,
                    lambda a: F.struct(
                        (-a["shared"]).alias("less"), (-a["dice"]).alias("minus"), t["place"].alias("place"), s.alias("s"), a["e"].alias("e")
                    ),
                )

            def known(c: Column) -> Column:
                """Does the text as a whole tell of it already?"""
                other = F.col("whole")
                here = F.array_intersect(F.slice("g", c["s"] + 1, c["e"] - c["s"] + 1), t["g"])
                told = (other["name"] == t["name"]) | (F.size(F.array_intersect(here, other["g"])) >= -c["less"] * least)
                return F.when(other.isNull(), F.lit(False)).otherwise(told)

            def from_hits(hits: Column) -> Column:
                def starts(s: Column, k: Column) -> Column:
                    within = lambda n, pairs: F.coalesce(F.get(hits, k + n - 1) < s + pairs, F.lit(False))
                    begins = F.coalesce(~F.get(m, s - 1)["hit"], F.lit(True)) | taken(s - 1)
                    return within(t["dense"], t["first"]) & within(t["low"], t["most"]) & begins & ~taken(s)

                found = F.transform(F.filter(hits, starts), best_from)
                return F.filter(found, lambda c: (-c["minus"] >= least) & ~known(c))

            hit = F.filter(F.transform(m, lambda x, i: F.when(x["hit"], i)), lambda i: i.isNotNull())
            return F.flatten(F.transform(F.array(hit), from_hits))

        marks = F.transform(
            "g", lambda x, i: F.struct(F.get("before", i).alias("before"), F.array_contains(F.get("of", i), t["place"]).alias("hit"))
        )
        return F.flatten(F.transform(F.array(marks), of_marks))

    some = F.filter(tables, lambda t: F.array_contains("places", t["place"]))
    return F.sort_array(F.flatten(F.transform(some, of_template)))


def _windows(some: DataFrame, ready: list[Template], least: float) -> DataFrame:
    """The windows of :func:`license_scan` that no line and no text as a whole tells of.

    All is done inside the row of a text: nothing is dealt out by a key. A round takes windows of a text that do not overlap; the next
    one looks in what they left free, until a text has no more.
    """
    tables = _tables(ready, least)
    ready = [t for t in ready if t.bigrams]
    fewest = min((t.low(least) for t in ready), default=1)

    def numbered(line: Column, no: Column) -> Column:
        def of(words: Column) -> Column:
            return F.transform(words, lambda w, k: F.struct(w.alias("w"), (no + 1).alias("line"), k.alias("k"), F.size(words).alias("n")))

        return F.flatten(F.transform(F.array(words_of(line)), of))

    # w: the words, each with its line, its place in the line and the line's number of words; g: the pairs
    words = some.select("doc_id", once(F.flatten(F.transform(F.split("text", "\n"), numbered)), "w")).where(F.size("w") > fewest)
    at = F.sequence(F.lit(0), F.size("w") - 2)
    pairs = words.select("*", once(F.transform(at, lambda i: F.concat_ws(" ", F.get("w", i)["w"], F.get("w", i + 1)["w"])), "g"))
    # of: the templates that have each pair
    told_of = pairs.select("*", once(F.transform("g", _lookup(ready)), "of"))
    hit = F.filter(F.transform("g", lambda x, i: F.when(F.size(F.get("of", i)) > 0, x)), lambda x: x.isNotNull())
    hits = told_of.select("*", once(F.array_distinct(hit), "hits")).where(F.size("hits") >= fewest)

    def can(t: Column) -> Column:
        enough = F.size(F.array_intersect(F.col("hits"), t["g"])) >= t["low"]
        return F.when((t["a"] > 0) & (F.size("hits") >= t["low"]) & enough, t["place"])

    places = F.filter(F.transform(tables, can), lambda p: p.isNotNull())
    hits = hits.select("doc_id", "w", "g", "of", once(places, "places")).where(F.size("places") > 0)
    # before: where each pair stands for the last time before, -1 for the first
    hits = hits.select("*", once(F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i")))), "order"))
    last = F.transform(
        "order",
        lambda o, k: F.struct(
            o["i"].alias("i"),
            F.when((k > 0) & (F.get("order", k - 1)["x"] == o["x"]), F.get("order", k - 1)["i"]).otherwise(F.lit(-1)).alias("before"),
        ),
    )
    hits = hits.select("*", once(F.transform(F.sort_array(last), lambda x: x["before"]), "before"))
    rows = hits.select("*", once(F.array_distinct("g"), "grams")).select(
        "doc_id", "w", "g", "of", "places", "before", once(_best_of(F.col("grams"), tables, least), "whole"),
        F.array().cast("array<struct<s:int,e:int>>").alias("taken"),
    )

    def apart(kept: Column, c: Column) -> Column:
        clash = F.exists(kept, lambda o: (o["s"] <= c["e"]) & (c["s"] <= o["e"]))
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(c)))

    found_in = _candidates(tables, least)
    rounds: list[DataFrame] = []
    while True:
        found = rows.select("*", once(F.aggregate(found_in, F.array().cast(_CANDIDATE), apart), "found"))
        found = staged(found.where(F.size("found") > 0), "license-windows")
        rounds.append(found.select("w", "g", "doc_id", F.explode("found").alias("c")))
        if found.isEmpty():
            break
        pairs_of = F.transform("found", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e")))
        rows = found.select("doc_id", "w", "g", "of", "places", "before", "whole", F.concat("taken", pairs_of).alias("taken"))
    kept = rounds[0]
    for more in rounds[1:]:
        kept = kept.unionAll(more)
    first, end = F.get("w", F.col("c.s")), F.get("w", F.col("c.e") + 1)
    one_line = F.when(first["line"] == end["line"], F.array_distinct(F.slice("g", F.col("c.s") - first["k"] + 1, first["n"] - 1)))
    named = kept.select("*", once(F.get(tables, F.col("c.place")), "own"), first["line"].alias("first"), end["line"].alias("last"), one_line.alias("line"))
    told = named.select("*", once(F.when(F.col("line").isNotNull(), _best_of(F.col("line"), tables, least)), "teller"))
    here = F.array_intersect(F.slice("g", F.col("c.s") + 1, F.col("c.e") - F.col("c.s") + 1), F.col("own.g"))
    by = F.col("teller")
    known = (by["name"] == F.col("own.name")) | (F.size(F.array_intersect(here, by["g"])) >= -F.col("c.less") * least)
    return told.where(by.isNull() | ~known).select(
        "doc_id",
        F.col("first").cast("long").alias("line_no"),
        F.col("last").cast("long").alias("last_line"),
        F.col("own.name").alias("license"),
        (-F.col("c.minus")).alias("dice"),
    )


def _best_of(grams: Column, tables: Column, least: float) -> Column:
    """Name and bigrams of the template that a set of bigrams reaches the coefficient with best; null if it does with none."""
    each = F.transform(tables, lambda t, i: F.struct(_dice(grams, t, least).alias("dice"), (-i).alias("place"), t["name"], t["g"]))
    return F.get(F.transform(F.filter(F.array(F.array_max(each)), lambda b: b["dice"] >= least), lambda b: F.struct(b["name"], b["g"])), F.lit(0))


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    least: float = 0.8,
    windows: bool = False,
) -> DataFrame:
    """A row for each licence notice: doc_id, line_no (0: the text as a whole), last_line, license, dice.

    Lines are numbered from 1 and end at line feeds; the text as a whole is compared if it has several lines. The template with
    the highest coefficient of at least ``least`` names the licence, the earlier one on ties. Null
    and empty texts and texts without notices give no row. Repeated rows each give their rows.

    With ``windows`` notices that go over several lines, or are part of one, give a row each, from the line of their first
    word to that of their last. A window starts at a pair of words that the template has and that no other such pair precedes, if of its
    first pairs (8, or as many as a notice needs) the share ``least`` / 2 is the template's: a thinner start would only lower the
    coefficient. It holds at most (2 - least) / least times the template's word pairs and ends where its coefficient is highest. Of windows
    that overlap the one with most of its template's bigrams stays (then the higher coefficient, the earlier template, the
    earlier start), so that a sentence which several licences have does not hide the licence it is part of. What the windows that
    stay leave free is searched again, until nothing is found. A window is left out if the text as a whole, or the line that it is
    part of, has a row for the same licence, or for one whose template has the share ``least`` of the bigrams that the window shares with its own.
    """
    ready = prepared(templates)
    if not ready or not 0 < least <= 1:
        raise ValueError("templates and a coefficient over 0 are needed")
    needed = F.array(*map(F.lit, _needed_words(ready, least)))
    sizes = [len(t.bigrams) for t in ready]
    low, high = min(sizes) * least / (2 - least), max(sizes) * (2 - least) / least
    some = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    some = some.where(F.arrays_overlap(words_of(F.col("text")), needed))
    if windows:
        some = staged(some, "license-texts")  # few texts have one of the words; both ways below read them
    lines = F.split("text", "\n")
    units = F.when(F.size(lines) > 1, F.concat(F.array("text"), lines)).otherwise(F.concat(F.array(F.lit("")), lines))
    rows = some.select("doc_id", F.posexplode(units).alias("line_no", "unit"))
    # the set of bigrams is at most as large as the words less one: short units go before they are paired
    cut = rows.select("doc_id", "line_no", once(words_of(F.col("unit")), "words")).where(F.size("words") - 1 >= low)
    grams = cut.where(F.arrays_overlap("words", needed)).select("doc_id", "line_no", once(bigrams_of(F.col("words")), "grams"))
    grams = grams.where(F.size("grams").between(low, high))
    n = F.size("grams")

    def against(t: Template) -> Column:
        """The coefficient with one template; zero beyond the size bounds."""
        a = F.lit(len(t.bigrams))
        shared = F.size(F.array_intersect(F.col("grams"), _set_of(t)))
        dice = F.when(2 * F.least(n, a) / (n + a) >= least, 2 * shared / (n + a)).otherwise(F.lit(0.0))
        return F.struct(dice.alias("dice"), F.lit(-t.place).alias("place"), F.lit(t.licence).alias("license"))

    best = F.array_max(F.array(*map(against, ready)))
    found = grams.select("doc_id", F.col("line_no").cast("long"), once(best, "best")).where(F.col("best.dice") >= least)
    told = found.select(
        "doc_id", "line_no", F.col("line_no").alias("last_line"), F.col("best.license").alias("license"), F.col("best.dice").alias("dice")
    )
    return told.unionByName(_windows(some, ready, least)) if windows else told
