"""Mixing, rollups and license scans against brute force."""

import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.errors import PySparkException

from obsengine.llm import licenses, mixing, rollup
from obsengine.llm.queries import op6_rollup
from obsengine.session import fresh_folder
from tests.conftest import rows

LEVELS = ["domain", "lang", "source"]
WEIGHTS = {"domain": {"web": 3, "books": 1}, "lang": {"en": 4, "xx": 0}}


def pour(budget, children):
    """Shares of (name, capacity, weight): fill by weight until someone is full, again and again."""
    share = {name: Fraction(0) for name, _, _ in children}
    left, open_ = Fraction(budget), list(children)
    while open_:
        total = sum(w for _, _, w in open_)
        full = [c for c in open_ if share[c[0]] + left * c[2] / total >= c[1]]
        if not full:
            for name, _, weight in open_:
                share[name] += left * weight / total
            break
        for name, capacity, _ in full:
            left -= capacity - share[name]
            share[name] = Fraction(capacity)
        open_ = [c for c in open_ if c not in full]
    whole = {name: int(s) for name, s in share.items()}
    order = sorted(share, key=lambda n: (-(share[n] - whole[n]), n is not None, n or ""))
    for name in order[: budget - sum(whole.values())]:
        whole[name] += 1
    return whole


def brute_budgets(leaves, budget, epochs, weights=WEIGHTS):
    def weight(level, name):
        return weights.get(level, {}).get(name, 1)

    leaves = {k: n for k, n in leaves.items() if all(map(weight, LEVELS, k))}
    budget = min(budget, epochs * sum(leaves.values()))

    def down(prefix, amount):
        depth = len(prefix)
        if depth == len(LEVELS):
            return {prefix: amount}
        inside = [k for k in leaves if k[:depth] == prefix]
        names = {k[depth] for k in inside}
        children = [
            (n, epochs * sum(leaves[k] for k in inside if k[depth] == n), weight(LEVELS[depth], n))
            for n in names
        ]
        out = {}
        for name, got in pour(amount, children).items():
            out |= down((*prefix, name), got)
        return out

    return down((), budget)


def documents(seed, n):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        source = rnd.choice(["s0"] * 8 + ["s1", "s2", None])
        out.append((i, rnd.choice(["web", "web", "books", None]), rnd.choice(["en", "de", "xx"]), source, rnd.randrange(0, 40)))
    return out


DDL = "doc_id long, domain string, lang string, source string, n_tokens long"


@pytest.mark.parametrize("share, epochs", [(0.3, 1), (0.7, 1), (1.7, 4), (9.0, 2), (0.0, 1)])
def test_mix(spark, share, epochs):
    docs = documents(int(share * 10), 300) + [(7, "web", "en", "s0", 5), (None, "web", "en", "s0", 30)]
    found = mixing.mix(spark.createDataFrame(docs, DDL), LEVELS, WEIGHTS, share, epochs).collect()
    leaves = Counter()
    for _, *key, n in docs:
        leaves[tuple(key)] += n
    leaves = {k: n for k, n in leaves.items() if n}
    wanted = brute_budgets(leaves, int(sum(leaves.values()) * share), epochs)
    got = Counter()
    for r in found:
        got[r.domain, r.lang, r.source] += r.taken
        assert 0 < r.taken <= r.n_tokens and r.epoch < epochs + (share >= 9)
    assert dict(got) == {k: n for k, n in wanted.items() if n}
    for key, amount in wanted.items():
        mine = [r for r in found if (r.domain, r.lang, r.source) == key]
        assert sum(r.taken < r.n_tokens for r in mine) <= 1
        complete = amount // leaves[key]
        each = Counter(r.doc_id for r in mine if r.epoch < complete)
        again = Counter(d[0] for d in docs if tuple(d[1:4]) == key and d[4])
        assert each == Counter({k: n * complete for k, n in again.items() if complete})


def test_levels_may_have_any_name(spark):
    inner = "budget capacity part available weight before rest left turn full spare open k n l0 l1".split()
    rnd = random.Random(5)
    table = [(i, rnd.choice("ab"), rnd.choice(["x", "y", None]), rnd.randrange(30)) for i in range(60)]
    weights = [{"a": 3}, {"x": 2}]
    plain = None
    for first, second in zip(inner[::2], inner[1::2]):
        docs = spark.createDataFrame(table, f"id long, `{first}` string, `{second}` string, size long")
        named = {first: weights[0], second: weights[1]}
        found = mixing.mix(docs, [first, second], named, 0.5, 2, key="id", tokens="size")
        assert found.columns == ["id", first, second, "size", "epoch", "taken"]
        plain = plain or rows(found)
        assert rows(found) == plain and plain
    with pytest.raises(ValueError, match="taken"):
        mixing.mix(docs.withColumnRenamed("l0", "taken"), ["taken", "l1"], {}, 0.5, key="id", tokens="size")


def test_mix_is_seeded_and_takes_empty_tables(spark):
    frame = spark.createDataFrame(documents(5, 200), DDL)
    one, same, other = (
        rows(mixing.mix(frame.repartition(p), LEVELS, {}, 0.4, seed=s)) for p, s in ((2, 1), (7, 1), (2, 2))
    )
    assert one == same != other
    assert mixing.mix(frame.limit(0), LEVELS, WEIGHTS, 0.5).count() == 0


CHANGES = "op string, source string, lang string, version string, n_tokens long, old_tokens long"


def test_rollup(spark):
    totals = rollup.TokenRollup(spark, fresh_folder(spark, "rollup"))
    assert totals.totals().count() == 0

    def apply(batch, *changes):
        return totals.apply(batch, spark.createDataFrame(list(changes), CHANGES))

    assert apply("a/1", ("insert", "s", "en", "v1", 10, None), ("insert", "s", "en", "v1", 5, None),
                 ("insert", None, None, "v1", None, None))
    assert apply("b", ("revise", "s", "en", "v1", 7, 5), ("delete", None, None, "v1", None, None))
    state = [("s", "en", "v1", 2, 17)]
    assert rows(totals.totals()) == state
    assert not apply("a/1", ("insert", "s", "en", "v1", 99, None))
    totals.compact()
    assert rows(totals.totals()) == state
    assert not apply("b", ("insert", "s", "en", "v1", 99, None))
    assert apply("c", ("delete", "s", "en", "v1", None, 10), ("insert", "t", "de", "v2", 1, None))
    assert apply("empty")
    totals.compact()
    assert rows(totals.totals()) == [("s", "en", "v1", 1, 7), ("t", "de", "v2", 1, 1)]
    assert totals.committed("empty") and not totals.committed("never")
    with pytest.raises(PySparkException, match="unknown change"):
        apply("bad", ("upsert", "s", "en", "v1", 1, None))
    assert not totals.committed("bad")
    assert apply("bad", ("insert", "s", "en", "v1", 1, None))


def test_files_without_a_marker_count_for_nothing(spark):
    changes = "op string, source string, lang string, version string, n_tokens long, old_tokens long"
    folder = fresh_folder(spark, "rollup-marker")
    totals = rollup.TokenRollup(spark, folder)
    one = spark.createDataFrame([("insert", "s", "en", "v", 10, None)], changes)
    assert totals.apply("done", one)
    # All files of a second batch are in place, only its marker is missing.
    assert totals.apply("lost", one)
    path = f"{folder}/deltas/{b'lost'.hex()}"
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    wanted = [("s", "en", "v", 1, 10)]
    assert rows(totals.totals()) == wanted and not totals.committed("lost")
    totals.compact()
    assert rows(totals.totals()) == wanted
    assert totals.committed("done") and not totals.committed("lost")
    assert totals.apply("lost", one) and not totals.apply("done", one)
    assert rows(totals.totals()) == [("s", "en", "v", 2, 20)]
    totals.compact()
    assert rows(totals.totals()) == [("s", "en", "v", 2, 20)] and totals.committed("lost")


def test_unfinished_batch_counts_for_nothing(spark):
    folder = fresh_folder(spark, "rollup")
    totals = rollup.TokenRollup(spark, folder)
    half = f"{totals._path('x')}/_temporary/0/task/part-0"
    spark.range(3).write.parquet(half)
    assert not totals.committed("x") and totals.totals().count() == 0
    change = spark.createDataFrame([("insert", "s", "en", "v", 3, None)], CHANGES)
    assert totals.apply("x", change)
    assert rows(totals.totals()) == [("s", "en", "v", 1, 3)]


def brute_scan(text):
    """Labels and phrase places by Python's re over the same rules."""
    lower = (text or "").translate(str.maketrans(licenses._UPPER, licenses._LOWER))
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    line = " " + " ".join(words) + " "
    places = sorted(
        (i, label)
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )
    hits = []
    for rule in licenses.rules():
        if rule.keyword in words:
            for m in re.finditer(rule.pattern, line):
                first = line.count(" ", 0, m.start())
                hits.append((first, first + m[0].count(" ") - 1, rule))
    kept = []
    for a, b, rule in hits:
        inside = any(
            c <= a and b <= d and (c, d, other) != (a, b, rule) and other.priority <= rule.priority
            and ((c, d) != (a, b) or (other.priority, other.number) < (rule.priority, rule.number))
            for c, d, other in hits
        )
        if not inside:
            kept.append(rule)
    labels = {label for _, label in places} | {r.label for r in kept}
    scores = [licenses.PHRASE_CONFIDENCE] * bool(places) + [r.confidence for r in kept]
    return (
        len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
        ",".join(sorted({label for _, label in places})), ",".join(sorted(labels)), max(scores, default=0.0),
    )


def test_scan(spark):
    texts = [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0. Released under the MIT License.",
        "licensed under cc by-nc 4.0 and CC BY", "CC-BY-NC-SA 4.0", "cc by cc by cc by",
        "apache apache license license", "mit dem GNU", "MİT License", "GNU Lesser General Public License v2.1",
        "SPDX-License-Identifier: BSD-3-Clause", "All rights reserved. public domain",
        "ünder the gnu\ngeneral, public license", "", None, "no words here at all", "mit license " * 3000,
        "distributed under the terms of the Mozilla Public License 2.0 or the GPL",
        "gnu general public licenses", "xmit license", "mit license1",
    ]
    rnd = random.Random(3)
    bits = " ".join(" ".join(licenses.PHRASES) for _ in range(1)).split() + ["gnu general public license", "the", "licensed under", "version 2", "apache license 2.0", "cc by", "lgpl"]
    texts += [" ".join(rnd.choices(bits, k=12)) for _ in range(60)]
    docs = [(i, t, "clash") for i, t in enumerate(texts)] + [(0, texts[0], "again"), (None, texts[1], "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, label string")
    found = licenses.summarise(frame).collect()
    assert len(found) == len(docs)
    wanted = sorted([(k, *brute_scan(t)) for k, t, _ in docs], key=repr)
    assert sorted([tuple(r) for r in found], key=repr) == wanted
    assert licenses.summarise(frame.limit(0)).count() == 0


def test_there_are_hundreds_of_rules():
    found = licenses.rules()
    assert len(found) > 300 and len({(r.pattern, r.label) for r in found}) == len(found)
    assert all(re.compile(r.pattern) for r in found)


#: Starts and sentences of real notices, and the labels they must have.
NOTICES = (
    ("License: GPLv2", "gpl"), ("GPLv3+", "gpl"), ("under LGPLv2.1 or later", "lgpl"), ("AGPLv3", "agpl"),
    ("GPL-3.0-or-later", "gpl"), ("license = Apache-2.0", "apache"), ("MPL-2.0", "mpl"), ("MPLv2", "mpl"),
    ('Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and '
     'associated documentation files (the "Software"), to deal\nin the Software without restriction', "mit"),
    ("The above copyright notice and this permission notice shall be included in all\ncopies or "
     "substantial portions of the Software.", "mit"),
    ("# Redistribution and use in source and binary forms, with or without\n# modification, are "
     "permitted provided that the following conditions are met:", "bsd"),
    (" * 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
     "endorse or promote products derived from this software without specific prior written permission.",
     "bsd-3-clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without "
     "fee is hereby granted, provided that the above", "isc"),
    ('Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee '
     'is hereby granted.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
     "REGARD TO THIS SOFTWARE", "0bsd"),
    ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU "
     "General Public License as published by", "gpl"),
    ("you may not use this file except in compliance with the License.\nYou may obtain a copy of the "
     "License at\n\n    http://www.apache.org/licenses/LICENSE-2.0", "apache"),
    ("If a copy of the MPL was not distributed with this\nfile, You can obtain one at "
     "https://mozilla.org/MPL/2.0/.", "mpl"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("3. Altered source versions must be plainly marked as such, and must not be\nmisrepresented", "zlib"),
    ("http://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa"),
)


def test_real_notices(spark):
    frame = spark.createDataFrame(
        [(i, text) for i, (text, _) in enumerate(NOTICES)], "doc_id long, text string"
    )
    found = {r.doc_id: r for r in licenses.summarise(frame).collect()}
    assert [found[i].labels for i in range(len(NOTICES))] == [labels for _, labels in NOTICES]
    assert [tuple(found[i])[1:] for i in range(len(NOTICES))] == [brute_scan(t) for t, _ in NOTICES]


def test_signatures_have_their_keyword():
    for _, keyword, words in licenses.JOINED + licenses.TEXTS:
        assert re.search(rf"\b{keyword}\b", re.sub(r"\(\?:", " ", words)), words


def test_rollup_keeps_one_row_a_text(spark, tmp_path):
    docs = [(1, "a 1", "s", "en"), (1, "a 1", "s", "en"), (2, "a 1", "s", "en"), (None, "a 1", "s", "en"),
            (3, None, "s", "en"), (4, None, "s", "en"), (None, None, "s", "en"), (5, "", "s", "en"),
            (None, "b", "s", "en"), (None, "b", "s", "en")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    wanted = [("s", "en", "marked-1", 4, 4), ("s", "en", "spaced-1", 4, 3)]
    assert rows(op6_rollup(spark, str(tmp_path))) == wanted
