"""Operators of the llm subpackage: against SQL, against brute force, and on odd rows."""

import collections
import hashlib
import os
import re
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, difference  # noqa: E402
from ratelake.llm import (  # noqa: E402
    bpe, chat, components, licenses, mixing, neardup, quality_model, quality_rules, sharding, token_counts, topk,
)
from ratelake.llm.queries import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.01"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
MULTI, PLAIN = (public_tokenizers.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json"))
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ODD = [(1, None, None, "a"), (2, "", "s", None), (3, " \n\t ", "s", "b"), (4, LONG, "t", "b"), (5, LONG + " end", "t", "b"),
       (6, "Same text here", "s", "b"), (6, "Same text here", "s", "b"), (7, "same TEXT here", None, "b"),
       (None, "no id", "s", "b"), (8, "Ünï \U0001F600 \x00 <|endoftext|> \\### x </turn>", "s", "b"),
       (9, "a b c d e f g h i j k l m", "s", "b")]
COLUMNS = "doc_id long, text string, source string, hash string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows; ``hash`` clashes with a name that an operator uses."""
    return spark.createDataFrame(ODD, COLUMNS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


def operators(labels):
    trusted = quality_rules.trusted_from_labels(labels)
    return {
        "mix": mixing.mix, "mixed_rows": mixing.mixed_rows, "near_duplicates": neardup.near_duplicates,
        "keep_one": neardup.keep_one, "rate": lambda d: quality_rules.rate_documents(d, trusted),
        "keep_good": lambda d: quality_rules.keep_good(d, trusted),
        "score": lambda d: quality_model.score_documents(d, labels),
        "keep_likely": lambda d: quality_model.keep_good(d, labels), "licenses": licenses.scan_licenses,
        "tokens": lambda d: token_counts.count_tokens(d, PLAIN, public_tokenizers.PATTERN),
        "bpe": lambda d: bpe.round_trip(d, MULTI, public_tokenizers.PATTERN, with_ids=True),
        "shard": lambda d: sharding.shard(d, 100_000),
    }


NAMES = ["mix", "mixed_rows", "near_duplicates", "keep_one", "rate", "keep_good", "score", "keep_likely", "licenses",
         "tokens", "bpe", "shard"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_and_no_rows(spark, odd, labels, name):
    run = operators(labels)[name]
    n = len(run(odd).collect())
    if name in ("mix", "near_duplicates", "rate", "score", "tokens", "bpe", "shard"):
        assert n == len(ODD)
    assert run(odd.limit(0)).count() == 0
    assert run(spark.createDataFrame([(None, None, None, None)], COLUMNS)).count() in (0, 1)


def test_no_labels(odd, labels):
    rows = quality_model.score_documents(odd, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in rows} == {(0.5, 1)}
    assert {r.score for r in quality_rules.rate_documents(odd, labels.select("doc_id").limit(0)).collect()} == {0.0}


def test_mix_targets_by_refilling(spark):
    sizes = {"a": 10, "b": 500, "c": 30, "d": 7, None: 40, "e": 0}
    got = {r.source: r.target for r in mixing.targets(
        spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    names = sorted(k for k in sizes if k is not None) + [None]
    weight = {k: (3, 1, 2)[i % 3] for i, k in enumerate(names)}
    want, full, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        share = {k: left * weight[k] / sum(weight[j] for j in names if j not in full) for k in names if k not in full}
        above = {k for k in share if share[k] > 2 * sizes[k]}
        if not above:
            break
        want |= {k: 2 * sizes[k] for k in above}
        left -= sum(2 * sizes[k] for k in above)
        full |= above
    want |= share
    assert got == pytest.approx(want)


def test_apportionment_by_one_seat_at_a_time(spark):
    from pyspark.sql import functions as F
    shares = [(1, 53.0), (2, 24.0), (3, 23.0), (4, 1.0), (5, 24.0), (6, 0.0)]
    for seats in (0, 1, 7, 100):
        got = {r.p: r.n for r in mixing.apportion(
            spark.createDataFrame(shares, "p int, share double"), [], "p", "share", F.lit(seats), "n").collect()}
        want = collections.Counter()
        for _ in range(seats):
            want[max(shares, key=lambda s: (s[1] / (2 * want[s[0]] + 1), -s[0]))[0]] += 1
        assert got == {p: want[p] for p, _ in shares}


def test_mix_is_near_its_targets(docs):
    rows = mixing.mix(docs).toPandas()
    by = rows.groupby("source").agg(taken=("taken", "sum"), target=("target", "max"))
    assert (abs(by.taken - by.target) <= 0.01 * by.target + 64).all() and (rows.taken <= 2 * rows["size"]).all()


def brute_sets(rows):
    out = {}
    for i, t in rows:
        w = WORDS.findall((t or "").encode().lower())
        out[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    return out


def test_near_duplicates_by_all_pairs(spark, docs):
    text = " ".join(f"w{i}" for i in range(60))
    chain = [(10_000 + i, " ".join(f"w{k}" for k in range(i * 4, i * 4 + 60))) for i in range(40)]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()] + chain + [(20_000 + i, text) for i in range(30)]
    sets = brute_sets(rows)
    parent = {i: i for i in sets}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    found = sorted(sets)
    for n, i in enumerate(found):
        for j in found[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    # A small block takes the path of large buckets.
    for block in (neardup.BLOCK, 4):
        got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
            i: (len(sets[i]), root(i), root(i) == i) for i in sets}


@pytest.mark.parametrize("settings", [{"rows": 5, "bands": 25}, {"similarity": 50}])
def test_near_duplicates_with_other_settings(spark, settings):
    """Pairs a little above the similarity, each alone in its buckets; banding may lose some, the signature check none."""
    given = {"rows": neardup.ROWS_PER_BAND, "bands": neardup.BANDS, "similarity": neardup.SIMILARITY} | settings
    rows, n = [], 400
    for i in range(n):
        words = [f"p{i}w{k}" for k in range(204)]
        cut = 28 if given["similarity"] == 75 else 66    # of 200 shingles; the others make 0.75 and 0.5
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:204 - cut] + [f"q{i}w{k}" for k in range(cut)]))]
    sets = brute_sets(rows)
    j = [len(sets[2 * i] & sets[2 * i + 1]) / len(sets[2 * i] | sets[2 * i + 1]) for i in range(n)]
    assert all(given["similarity"] <= 100 * x < given["similarity"] + 1.5 for x in j)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **settings).collect()
    linked = {r.doc_id for r in got if not r.kept}
    assert linked <= {2 * i + 1 for i in range(n)}
    banded = n * (1 - (1 - j[0] ** given["rows"]) ** given["bands"])
    assert len(linked) >= banded - 5 * (banded * (1 - banded / n)) ** 0.5 - 1e-6 * n


def test_near_duplicates_of_repeated_and_null_ids(spark):
    """Each text of a repeated id keeps its own links, in buckets of any size; null ids stand alone."""
    def text(name, end=""):
        return " ".join([f"{name}{k}" for k in range(100)] + [end or f"{name}100"])
    rows = [(1, text("a")), (1, text("b")), (1, text("b")), (1, text("a", "x")),
            # Near copies of each of the texts of 1, and of each other; 9 has only its second text in common.
            (2, text("a", "y")), (3, text("b", "y")), (4, text("b", "z")), (9, text("c")), (9, text("d")), (8, text("d", "y")), (7, text("d", "z")),
            (6, text("c", "y")), (5, text("e")), (None, text("e")), (None, text("e")), (None, None), (20, text("e")), (30, text("f"))]
    # Large buckets: a repeated id is the smallest of all and has one text in each of two groups.
    rows += [(0, text("g")), (0, text("h"))] + [(100 + i, text("gh"[i % 2], f"y{i}")) for i in range(40)]
    want = {**dict.fromkeys((1, 2, 3, 4), 1), **dict.fromkeys((6, 7, 8, 9), 6), 5: 5, 20: 5, 30: 30, 0: 0,
            **{100 + i: 0 for i in range(40)}, None: None}
    for block in (neardup.BLOCK, 4):
        got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
        assert collections.Counter(r.doc_id for r in got) == collections.Counter(i for i, _ in rows)
        assert {r.doc_id: r.component_id for r in got} == want and all(r.component_id == want[r.doc_id] for r in got)
        assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (300, 200), (7, 7)] + [(400, 400 + i) for i in range(1, 30)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 200: 100, 300: 100, **{400 + i: 400 for i in range(30)}}


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    again = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again))


def test_quality_rules(spark, docs, labels, odd):
    got = quality_rules.rate_documents(docs, quality_rules.trusted_from_labels(labels)).toPandas().set_index("doc_id")
    raw, good = collections.Counter(), collections.Counter()
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1}
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}

    def grams(t):
        return [((int.from_bytes(t[i:i + 3], "big") * 2654435761) & 0xFFFFFFFF) >> 16 for i in range(len(t) - 2)]

    for i, t in texts.items():
        raw.update(grams(t))
        if i in trusted:
            good.update(grams(t))
    n_raw, n_good = sum(raw.values()) + 65536, sum(good.values()) + 65536
    for i, t in list(texts.items())[::7]:
        words, *_, again = want = brute_rules(t.decode())
        row = got.loc[i]
        assert tuple(row[list(quality_rules.LONGS)]) == want
        score = np.mean([np.log((good[g] + 1) / n_good) - np.log((raw[g] + 1) / n_raw) for g in grams(t)] or [0])
        assert row.score == pytest.approx(score, abs=1e-4)
        failed = words < 10 or 100 * again > 20 * words
        assert row.base_failed == failed and row.kept == (not failed and row.score >= quality_rules.THRESHOLD)
    marked = got.join(labels.toPandas().set_index("doc_id"), how="inner")
    fine = marked[~marked.base_failed]
    assert fine[fine.quality == 1].kept.all() and fine[fine.quality == 0].kept.mean() < 0.05
    rows = quality_rules.rate_documents(odd, labels.select("doc_id").limit(0)).collect()
    want = collections.Counter((i, *brute_rules(t)) for i, t, *_ in ODD)
    assert collections.Counter(tuple(r[:6]) for r in rows) == want


def test_quality_classifier_on_held_out_rows(docs, labels):
    import zlib
    got = quality_model.score_documents(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.95


def test_top_products_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(300 + i, [0.5] * 6) for i in range(60)]
    rows += [(400, None), (401, [None] * 6), (402, [float("nan")] + [0.0] * 5), (500, [float("inf")] * 6), (600, [0.0] * 6), (700, [])]
    from pyspark.sql import functions as F
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in topk.top_products(frame, F.col("vec_id") % 100 == 0, block=40, query_block=2).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    ints = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows if v is not None and all(
        x is not None and np.isfinite(x) for x in v)}
    want = {q: sorted(((i, sum(a * b for a, b in zip(v, ints[q]))) for i, v in ints.items() if i != q),
                      key=lambda x: (-x[1], x[0]))[:10] for q in ints if q % 100 == 0}
    assert dict(got) == want
    assert topk.top_products(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert topk.top_products(frame.limit(3), F.col("vec_id") == 0).count() == 2


def test_token_counts_and_bpe_as_their_libraries(docs, odd):
    import tiktoken
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PLAIN)
    ranks = bpe.read_ranks(MULTI)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for frame in (docs, odd):
        want = collections.Counter()
        for r in frame.collect():
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            want[(r.doc_id, len((r.text or "").encode()), n, n > 1024)] += 1
        assert collections.Counter(map(tuple, token_counts.count_tokens(frame, PLAIN, public_tokenizers.PATTERN).collect())) == want
        want = collections.Counter()
        for r in frame.collect():
            ids = other.encode_ordinary(r.text or "")
            want[(r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256((r.text or "").encode()).hexdigest())] += 1
        assert collections.Counter(map(tuple, bpe.round_trip(frame, MULTI, public_tokenizers.PATTERN).collect())) == want
    encoded = bpe.encode(odd, MULTI, public_tokenizers.PATTERN)
    assert collections.Counter((r.doc_id, bytes(r.bytes)) for r in bpe.decode(encoded, MULTI, public_tokenizers.PATTERN).collect()) == \
        collections.Counter((i, (t or "").encode()) for i, t, *_ in ODD)


def test_chat_parts(spark):
    part = lambda kind, **more: {"type": kind, **more}
    rows = [(1, 0, "user", [part("text", text="look <here>"), part("image", ref="a.png", width=600, height=100),
                            part("audio", ref="b.wav", seconds=1.5)]),
            (1, 1, "assistant", [part("document", ref="c.pdf", pages=3), part("text", text="a\\b # </turn>")]),
            (2, 0, None, None), (2, None, "assistant", [part("text", text=None)]), (None, 0, "a: b", [])]
    turns = chat.format_turns(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>"))
    first = {(r.conv_id, r.turn): r for r in turns.collect()}
    assert first[1, 0].formatted == "### user: look \\<here><image:1><audio:2></turn>\n"
    assert [(a.placeholder, a.ref, a.tokens) for a in first[1, 0].attachments] == [("<image:1>", "a.png", 340), ("<audio:2>", "b.wav", 50)]
    assert first[1, 1].expanded_tokens == 1500
    got = {r.conv_id: r for r in chat.digests(turns).collect()}
    text = "user\nlook <here><image:1><audio:2>\nassistant\n<document:1>a\\b # </turn>\n"
    assert got[1].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert (got[1].n_turns, got[2].n_turns, got[None].n_turns) == (2, 2, 1)
    assert got[2].turns_sha256 == hashlib.sha256(b"assistant\n\n\n\n").hexdigest()
    assert chat.digests(turns.limit(0)).count() == 0
    with pytest.raises(Exception, match="unknown content part"):
        chat.format_turns(spark.createDataFrame([(1, 0, "user", [part("video")])], f"conv_id long, turn long, role string, parts array<{chat.PART}>")).collect()


def test_shards_hold_their_limit(spark, docs):
    from pyspark.sql import functions as F
    copies = docs.limit(1).select(docs.columns).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("k")
    for frame, limit in ((docs, 20_000), (copies, 100_000)):
        rows = sharding.shard(frame, limit).toPandas()
        assert len(rows) == frame.count()
        by = rows.groupby("shard").agg(bytes=("bytes", "sum"), n=("bytes", "size"), said=("shard_bytes", "max"), docs=("shard_docs", "max"))
        assert (by.bytes == by.said).all() and (by.n == by.docs).all() and ((by.bytes <= limit) | (by.n == 1)).all()
        names = sorted(by.index)
        assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
        for name in names:    # no bucket was split without need
            if name:
                both = by[by.index.str.startswith(name[:-1])]
                assert both.bytes.sum() > limit and both.n.sum() > 1


def test_licenses(spark):
    notice = licenses.TEMPLATES["GPL-3.0"]
    noise = "the work under a general idea of this is not public " * 300
    rows = [(1, f"{noise}{notice} {noise}"), (2, notice.upper()), (3, notice + " and " + notice), (4, noise),
            (5, "This work is now licensed under the old GNU General Public License, version 3."), (6, "license")]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {1, 2, 3, 5} and {r.license for r in got.values()} == {"GPL-3.0"}
    assert got[1].first_word == 3300 and got[1].coverage == 1 and got[3].first_word == 0 and got[5].n_matched == 12
    assert licenses.align(list("abcxyz"), list("abqxyz")) == [(0, 0), (1, 1), (3, 3), (4, 4), (5, 5)]


def test_licenses_at_every_offset(spark):
    notices = {"MIT": "Released under the terms of the permissive MIT License",
               "Apache-2.0": "Licensed under the terms of the well known Apache License, Version 2.0"}
    for name, notice in notices.items():
        size = len(licenses.words_of(licenses.TEMPLATES[name]))
        rows = [(k, f"{'filler ' * k}{notice}{tail}") for k, tail in enumerate(["", " filler", " the license under the license"] * 8)]
        got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
               if r.license == name}
        assert set(got) == set(range(24))
        for k, r in got.items():
            assert (r.n_matched, r.coverage, r.first_word, r.last_word) == (
                size, 1, k, k + len(licenses.words_of(notice)) - 1)
    # No word is unique on both sides; two copies with words put in.
    assert len(licenses.align(list("babxaab"), list("ababab"))) == 5
    twice = "Released now under the same MIT License or released again under the very MIT License"
    assert len(licenses.best_alignment(licenses.words_of(twice), licenses.words_of(licenses.TEMPLATES["MIT"]), 4)) == 5
    # Against the longest common run of words over all places.
    rng = np.random.default_rng(3)
    template = licenses.words_of("the holder of the work gives the user of the work a right to the copy of it")
    for _ in range(60):
        copy = [w for t in template for w in ([t] + ["zzz"] * rng.integers(0, 2))]
        noise = [*rng.choice(template + ["zzz"] * 20, rng.integers(0, 60))]
        assert len(licenses.best_alignment(noise + copy + noise, template, 10)) == len(template)


RIVALS = [
    "Released under the BSD License.", "Released under the ISC License.", "Released under the MIT No Attribution License.",
    "Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.", "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY-NC 3.0.",
    "Licensed under the Apache License, Version 1.1.", "Licensed under the Mozilla Public License, Version 2.0.",
    "Licensed under the Educational Community License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.osedu.org/licenses/ECL-2.0",
    "This work is licensed under the GNU General Public License, version 2.",
    "This work is licensed under the GNU Lesser General Public License, version 3.",
    "This work is licensed under the GNU Affero General Public License, version 3.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal with the Software without restriction, including without limitation the rights to use"]
GIVEN = {"Apache-2.0", "Apache-2.0-header", "CC-BY-NC-4.0", "GPL-3.0", "MIT", "MIT-grant"}


def test_rival_licenses(spark):
    near = [("Apache-2.0", "Licensed under the Apache License 2.0"), ("MIT", "Released under the BSD License or the MIT License"),
            ("GPL-3.0", "This work is licensed under the GNU General Public License, version 2 or version 3"),
            ("CC-BY-NC-4.0", "Licensed also under CC BY-NC 4.0")]
    rows = list(enumerate(RIVALS)) + [(100 + i, t) for i, (_, t) in enumerate(near)]
    got = {(r.doc_id, r.license) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {g for g in got if g[1] in GIVEN} == {(100 + i, name) for i, (name, _) in enumerate(near)}
    # Each deciding phrase is one of its template, so that the template itself is found.
    for name, text in licenses.TEMPLATES.items():
        phrases = [[licenses.words_of(w) for w in p.split("|")] for p in licenses.DECIDING[name]]
        words = licenses.words_of(text)
        assert len(licenses.best_alignment(words, words, len(words), phrases)) == len(words), name


def test_license_catalogue(spark):
    headers = {
        "GPL-2.0-header": "This program is free software; you can redistribute it and/or\n# modify it under the terms of the GNU "
                          "General Public License\n# as published by the Free Software Foundation; either version 2\n# of the "
                          "License, or (at your option) any later version.",
        "LGPL-3.0-header": "Foo is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                           "Public License as published by the Free Software Foundation, version 3 of the License.",
        "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                          "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "CC-BY-SA-4.0-header": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
        "BSD-3-Clause": "Released under the BSD 3-Clause License"}
    found = {i: name for i, name in enumerate(licenses.TEMPLATES)}
    rows = [(i, f"Copyright of the holder. {licenses.TEMPLATES[name]} End of the text") for i, name in found.items()]
    rows += [(1000 + i, t) for i, t in enumerate(headers.values())]
    got = collections.defaultdict(set)
    for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id].add(r.license)
    assert [got[1000 + i] for i in range(len(headers))] == [{name} for name in headers]
    # Texts that hold other templates; NCSA isn't MIT, three clauses aren't two.
    also = {"Apache-2.0-header": {"Apache-2.0"}, "Apache-2.0-text": {"Apache-2.0", "Apache-2.0-header"}, "MIT-text": {"MIT-grant"}} | {
        f"{k}-text": {f"{k}-header"} for k in ("GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "MPL-2.0")}
    assert {name: got[i] for i, name in found.items()} == {name: {name} | also.get(name, set()) for name in found.values()}
    assert {"MIT-text", "Apache-2.0-text", "GPL-2.0-text", "GPL-3.0-text", "BSD-2-Clause-text", "BSD-3-Clause-text", "ISC-text",
            "MPL-2.0-text", "CC-BY-SA-4.0-text", "CC0-1.0-text"} <= set(found.values())


def brute_features(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n_words, chars, symbols, dup_lines, again = brute_rules(text)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n"))
    n, c, raw = max(n_words, 1), max(chars, 1), text.encode()
    upper, lower = (len(re.findall(p, text)) for p in ("[A-Z]", "[a-z]"))
    return [np.log1p(n_words), chars / n, symbols / c, upper / max(upper + lower, 1), len(re.findall("[0-9]", text)) / c,
            sum(text.count(x) for x in ".,;:?") / c, text.count("!") / c, dup_lines / max(lines, 1), again / n, len(set(words)) / n,
            np.log1p(n_words / max(lines, 1)), sum(w.endswith(".") for w in words) / n,
            sum(a == b for a, b in zip(words, words[1:])) / n, sum(len(w.encode()) == 1 for w in words) / n,
            sum(b >= 128 for b in raw) / max(len(raw), 1), sum(w[-1] in "#*$%&|<>" for w in words) / n]


def test_stage_decisions_in_plain_python(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = lambda d: collections.Counter(r.doc_id for r in d.collect())
    # Rules.
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1}
    grams = {i: [((int.from_bytes(t[k:k + 3], "big") * 2654435761) & 0xFFFFFFFF) >> 16 for k in range(len(t) - 2)]
             for i, t in ((i, t.encode()) for i, t in texts.items())}
    raw, good = collections.Counter(), collections.Counter()
    for i, g in grams.items():
        raw.update(g)
        good.update(g if i in trusted else ())
    n_raw, n_good = sum(raw.values()) + 65536, sum(good.values()) + 65536
    kept = collections.Counter()
    for i, t in texts.items():
        words, *_, again = brute_rules(t)
        score = np.mean([np.log((good[g] + 1) / n_good) - np.log((raw[g] + 1) / n_raw) for g in grams[i]] or [0])
        kept[i] += words >= 10 and 100 * again <= 20 * words and score >= -0.5
    assert ids(quality_rules.keep_good(docs, quality_rules.trusted_from_labels(labels))) == +kept
    # Features and classifier.
    features = quality_model.text_features(docs)
    x = {r.doc_id: r.features for r in features.collect()}
    want = {i: np.float32(brute_features(t)) for i, t in texts.items()}
    for i in want:
        assert x[i] == pytest.approx(list(want[i]), rel=1e-5, abs=1e-7), i
    model = quality_model.learn(features, labels)
    kept = collections.Counter()
    for i, row in x.items():
        place = lambda cuts, f: sum(np.float32(row[f]) > c for c in cuts[f])
        score = model["intercept"] + sum(t[place(model["cuts"], f)] for f, t in enumerate(model["tables"]))
        score += sum(t[place(model["coarse"], a), place(model["coarse"], b)] for a, b, t in model["pairs"])
        kept[i] += bool(score >= 0)
    assert ids(quality_model.keep_good(docs, labels)) == +kept
    # Whole copies of the mix, whose words have SQL.
    taken = collections.Counter({r.doc_id: int(r.taken / r["size"] + 0.5) if r["size"] else 0 for r in mixing.mix(docs).collect()})
    assert ids(mixing.mixed_rows(docs)) == +taken
    # Licences: the notices of these documents stand in them without words put in.
    got = {(r.doc_id, r.license) for r in licenses.scan_licenses(docs).collect()}
    line = lambda t: " " + " ".join(licenses.words_of(t)) + " "
    assert got == {(i, name) for i, t in texts.items() for name, n in licenses.TEMPLATES.items() if line(n) in line(t)}


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline
    got = collections.Counter(r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect())
    now = docs
    for (name, function), _ in zip(corpus_pipeline.STAGES[:-1], range(9)):
        before = now
        now = function(spark, now, FOLDER)
        assert now.columns == docs.columns
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        if name != "mix_sources":
            assert now.count() <= before.count() and now.count() == now.select("doc_id").distinct().count()
    assert got == collections.Counter(r.doc_id for r in now.select("doc_id").collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "near_duplicates", "mix_sources", "byte_level_bpe"]


def letter_swap(n, swap=False):
    """The Thue-Morse word of 2^n letters, or the one with both letters swapped."""
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(1 << n))


def test_texts_of_equal_build_are_told_apart(spark):
    """Texts that any polynomial hash modulo 2^64 takes for equal."""
    one, other = letter_swap(11), letter_swap(11, True)
    tail = " ".join(f"w{i}" for i in range(12))
    rows = [(1, one), (2, other), (3, f"{one}\n{other}"), (4, f"{one}\n{tail}"), (5, f"{other}\n{tail}"), (6, f"{one}\n{one}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.component_id, r.n_shingles) for r in neardup.near_duplicates(df).collect()}
    assert found == {1: (1, 1), 2: (2, 1), 3: (3, 1), 4: (4, 9), 5: (4, 9), 6: (6, 1)}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lines = {r.doc_id: r.n_dup_lines for r in quality_rules.rate_documents(df, quality_rules.trusted_from_labels(labels)).collect()}
    assert lines == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1}


def test_links_are_confirmed_on_words():
    """Numbers of shingles are equal only for equal words, in texts of any size."""
    bytetext = neardup.bytetext
    texts = [b"a b c d e f", b"A b c d E f g", b"a b", b"b a", b"A  b", b"", b"x " * 9]
    sets = [set(s.tolist()) for s in bytetext.exact_sets(texts, 5)]
    assert [len(s) for s in sets] == [2, 3, 1, 1, 1, 0, 1]
    assert sets[0] < sets[1] and sets[2] == sets[4] != sets[3] and not sets[6] & sets[1]
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["x", "y", "Z"], rng.integers(0, 40))).encode() for _ in range(60)]
    plain = []
    for t in texts:
        w = tuple(t.lower().split())
        plain.append({w[i:i + 5] for i in range(len(w) - 4)} if len(w) >= 5 else {w} - {()})
    found = bytetext.exact_sets(texts, 5)
    for i in range(60):
        for j in range(60):
            assert len(np.intersect1d(found[i], found[j])) == len(plain[i] & plain[j])
    names = bytetext.Slice([letter_swap(12).encode(), letter_swap(12, True).encode()]).word_hashes()
    assert names[0] != names[1]


HELPERS = ["_id", "_copies", "id", "times", "place", "size", "_size", "taken", "_taken", "source_no", "shard", "rep", "label", "bucket", "n", "main",
           "salt", "kept", "component_id", "score", "features", "_label", "weights", "trusted", "text_hash", "n_shingles", "vec_id", "row"]


def test_stages_with_the_names_that_they_use(spark, labels, tmp_path):
    """Extra columns of any name go through every stage of the pipeline."""
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    for k, name in enumerate(HELPERS):
        docs = docs.withColumn(name, F.lit(k))
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert name == "byte_level_bpe" or out.columns == docs.columns
        rows = out.collect()
        assert rows and (name == "byte_level_bpe" or all(r["_copies"] == 1 and r["row"] == len(HELPERS) - 1 for r in rows))
