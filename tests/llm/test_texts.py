import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from codecorpus.llm import fingerprints, licenses, queries, sentencepieces, sharding
from codecorpus.llm.decontaminate import count_words


def documents(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


# --- fingerprints ---------------------------------------------------------------


def jaccard(a, b):
    a, b = (Counter(x.encode().lower().split() or [b""]) for x in (a, b))
    return sum((a & b).values()) / sum((a | b).values())


def test_edited_texts_and_likeness(spark, sf):
    texts = documents(spark, sf)
    order = sorted(texts, reverse=True)
    found = {r.doc_id: r for r in queries.op3_fingerprints(spark, sf).collect()}
    errors, seen = [], {}
    for i, nxt in zip(order, order[1:] + order[:1], strict=True):
        text, half, r = texts[i], len(texts[i]) // 2, found[i]
        edited = text[: len(text) - half] + texts[nxt][:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint
        pieces = [[f[k : k + 4] for k in range(0, len(f), 4)] for f in (r.fingerprint, r.edited_fingerprint, found[nxt].fingerprint)]
        assert r.near_edited == sum(map(str.__eq__, pieces[0], pieces[1])) / len(pieces[0])
        assert r.near_next == sum(map(str.__eq__, pieces[0], pieces[2])) / len(pieces[0])
        errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, texts[nxt])]
    assert abs(sum(errors)) / len(errors) < 0.02 and sum(e * e for e in errors) / len(errors) < 0.01


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_neighbours_do_not_depend_on_ranges(spark, ranges):
    ids = random.Random(1).sample(range(-500, 500), 200)
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(5)
    rows = fingerprints.neighbours(docs, ranges=ranges).filter("not halo").collect()
    order = sorted(ids, reverse=True)
    assert {r.key: r.next_text for r in rows} == {i: f"t{n}" for i, n in zip(order, order[1:] + order[:1], strict=True)}


def test_fingerprints_of_odd_rows(spark, odd_docs, odd_rows):
    rows = fingerprints.edited_fingerprints(odd_docs).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert len({r.fingerprint for r in rows if not r.n_chars}) == 1
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in rows) == sorted((i is None, i or 0, len(t or "")) for i, t, _ in odd_rows)
    one = fingerprints.edited_fingerprints(odd_docs.filter("doc_id = 7")).first()
    assert one.near_next == 1.0
    assert fingerprints.edited_fingerprints(odd_docs.filter("false")).count() == 0
    general = fingerprints.fingerprint(odd_docs).collect()
    assert {r.fingerprint for r in general} == {r.fingerprint for r in rows}


# --- shards ---------------------------------------------------------------------


def check_shards(rows, found, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    for s in range(shards):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.size
    target = sum(sizes.values()) / shards
    slack = max(r.size for r in found) + sharding.KEEP_TOGETHER * target
    assert all(abs(sizes[s] - target) <= slack for s in range(shards))


def test_shards_of_documents(spark, sf):
    texts = documents(spark, sf)
    found = queries.op4_sharding(spark, sf).collect()
    check_shards(list(texts.items()), found, 40)
    assert {r.law for r in found} == {"bytes"}


def test_hot_group_is_cut_and_small_groups_are_not(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i // 6}") for i in range(3000)]
    found = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=7).collect()
    check_shards(rows, found, 7)
    where = {}
    text = dict(rows)
    for r in found:
        where.setdefault(text[r.doc_id], set()).add(r.shard)
    assert [t for t, s in where.items() if len(s) > 1] == ["hot text"]


def test_shards_of_odd_rows(spark, odd_docs, odd_rows):
    found = sharding.assign_shards(odd_docs, shards=3).collect()
    check_shards([(i, t) for i, t, _ in odd_rows], found, 3)
    assert sharding.assign_shards(odd_docs.filter("false")).count() == 0


# --- licenses -------------------------------------------------------------------


def plain_base(text):
    words, starts, labels = words_of(text), [], set()
    for phrase, label in licenses.BASE.items():
        at = [i for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


LICENSED = [
    (1, "Licensed under the Apache License, Version 2.0."), (2, "MIT License MIT license, and (CC BY) cc-by 4.0"),
    (3, "GNU General Public License, version 3 or later; see the GNU Lesser General Public License v2.1"),
    (4, "SPDX-License-Identifier: BSD-3-Clause"), (5, "mitlicense amit license x"), (6, "MIT " * 5 + "License"), (7, None), (8, "all rights reserved"),
]


def test_base_phrases_and_labels(spark, sf):
    rows = LICENSED + list(documents(spark, sf).items())
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    for k, (_, text) in enumerate(rows):
        r = found[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert found[0].labels == "apache,apache-2.0" and found[3].labels == "bsd-3-clause" and found[7].labels == "proprietary"
    assert found[2].labels == "gpl,gpl-3.0,lgpl-2.1" and found[4].labels == ""
    spans = licenses.license_spans(docs.filter("doc_id = 0")).collect()
    assert [(s.start_word, s.end_word, s.label, s.priority) for s in spans] == [(0, 7, "apache-2.0", 2)]


def test_licenses_of_odd_rows(spark, odd_docs, odd_rows):
    assert licenses.scan_licenses(odd_docs).count() == len(odd_rows)
    assert licenses.scan_licenses(odd_docs.filter("false")).count() == 0
    assert len(licenses.rules()) > 200


def test_rules_are_valid_patterns():
    for rule in licenses.rules():
        assert re.compile(rule.pattern).search("") is None and rule.priority in (1, 2, 3)


# --- pieces ---------------------------------------------------------------------


def all_paths(pieces, part):
    """Every segmentation with its score."""
    if not part:
        return [(0.0, ())]
    found = []
    for k in range(1, len(part) + 1):
        if part[:k] in pieces.pieces:
            piece, score = pieces.pieces[part[:k]]
            found += [(score + s, (piece, *ids)) for s, ids in all_paths(pieces, part[k:])]
    if part[0] not in pieces.pieces:
        raw = tuple(pieces.byte_ids[b] for b in part[0].encode())
        found += [(pieces.byte_score * len(raw) + s, raw + ids) for s, ids in all_paths(pieces, part[1:])]
    return found


@pytest.mark.parametrize("text", ["hello, wör", "the  ▁a\n漢b", "x", "  ", "", "loweischaft!!"])
def test_n_best_equal_all_paths(text):
    pieces = sentencepieces.Pieces(n_best=4)
    want = sorted((s for s, _ in all_paths(pieces, " " + text)), reverse=True)[:4] if text else []
    ids, scores = pieces.encode(text)
    assert scores == pytest.approx(want) and pieces.decode(ids) == text
    lists = pieces.segmentations(text)
    assert [s for s, _ in lists] == pytest.approx(want) and all(pieces.decode(x) == text for _, x in lists)
    assert len({tuple(x) for _, x in lists}) == len(lists) and (not text or lists[0][0] == pytest.approx(scores[0]))


def test_cache_does_not_change_results():
    small, large = sentencepieces.Pieces(), sentencepieces.Pieces()
    small.parts.limit = 3
    for text in ("one two three one four two five one " * 3, "six one"):
        assert small.encode(text) == large.encode(text)
    assert len(small.parts) + len(small.parts.old) <= 3


def test_pieces_of_odd_rows(spark, odd_docs, odd_rows):
    rows = sentencepieces.encoded(odd_docs).collect()
    assert len(rows) == len(odd_rows) and all(r.exact and r.n_pieces == len(r.ids) for r in rows)
    assert {r.n_pieces for r in rows if r.doc_id in (2, 3)} == {0}
    ids = odd_docs.select("doc_id", "text", sentencepieces.encode(odd_docs.text).ids.alias("ids"))
    back = ids.select("text", sentencepieces.decode(ids.ids).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in back)
    assert sentencepieces.encoded(odd_docs.filter("false")).count() == 0


def test_pieces_of_documents(spark, sf):
    rows = queries.op9_sentencepiece(spark, sf).collect()
    assert len(rows) == len(documents(spark, sf)) and all(r.exact for r in rows)
    assert all(a >= b for r in rows for a, b in itertools.pairwise(r.scores))


def test_count_words(spark, odd_docs, odd_rows):
    found = odd_docs.select("text", count_words(odd_docs.text).alias("n")).collect()
    assert all(r.n == len(words_of(r.text)) for r in found)
