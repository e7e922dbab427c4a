import itertools
import random

import pytest

from codecorpus.llm import queries, sentencepieces


@pytest.mark.parametrize("text", ["hello, wör the the hello", "the  ▁a\n漢b", "loweischaft!!", "x", ""])
def test_all_segmentations_are_kept(text):
    pieces = sentencepieces.Pieces()
    ids, scores, further = pieces.encode_all(text)
    want = pieces.segmentations(text)
    paths = [ids, *(sentencepieces.replaced(ids, x) for x in further)] if text else []
    assert len(paths) == len(scores) == len(want) == len({tuple(x) for x in paths})
    assert scores == pytest.approx([s for s, _ in want])
    score = lambda x: sum({i: s for i, s in pieces.pieces.values()}.get(i, pieces.byte_score) for i in x)
    assert [score(x) for x in paths] == pytest.approx(scores) and all(pieces.decode(x) == text for x in paths)


def test_query_returns_all_segmentations(spark, sf):
    pieces = sentencepieces.Pieces()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op9_sentencepiece(spark, sf).collect():
        assert len(r.further) == max(0, len(r.scores) - 1) and r.exact
        assert all(pieces.decode(sentencepieces.replaced(list(r.ids), x)) == (texts[r.doc_id] or "") for x in r.further)


def test_parts_solved_together_equal_parts_solved_alone():
    """In order, a part takes over the lattice of the start it shares with the one before: few places are searched anew."""
    words = [" loweischaft", " lower", " lowest", "low", " low", " 漢字", " 漢", "abab" * 5, "ababa", " x", " aabaa", "é", " lowe\u0001", "z" * 60]
    words += [f" {a}{b}{c}" for a in ("over", "under", "inter") for b in ("stand", "state", "tion", "ing") for c in ("s", "ed", "ing", "ly", "er")]
    together, alone, places = sentencepieces.Pieces(), sentencepieces.Pieces(), []
    lattice = together.lattice

    def counted(part, known=None):
        places.append(len(part) + 1 - (len(known[1]) if known else 1))
        return lattice(part, known)

    together.lattice = counted
    together.solve_all(set(words))
    assert sum(places) < sum(map(len, words)) / 2
    assert dict(together.parts) == {w: alone.parts[w] for w in words if len(w) <= sentencepieces.LONGEST_KEPT}
    for word in words:
        every, ways = alone.lattice(word)[0], {0: [()]}
        for j in range(1, len(word) + 1):
            ways[j] = [(*way, *ids) for i, ids, _ in every[j] for way in ways[i]] if len(word) < 14 else []
        if ways[len(word)]:  # all paths, by their scores
            score = {i: s for i, s in alone.pieces.values()}
            best = sorted((sum(score.get(i, alone.byte_score) for i in way) for way in ways[len(word)]), reverse=True)[:3]
            assert [s for s, _ in alone.paths(word)] == pytest.approx(best)


def test_small_runs_of_rows_give_the_same(spark, odd_docs, monkeypatch):
    want = sorted(map(str, sentencepieces.encoded(odd_docs).collect()))
    monkeypatch.setattr(sentencepieces, "CHARS_SOLVED", 50)
    monkeypatch.setattr(sentencepieces, "ROWS_SOLVED", 3)
    assert sorted(map(str, sentencepieces.encoded(odd_docs).collect())) == want and len(want) == odd_docs.count()


def odd_texts(n):
    draw = random.Random(n)
    alphabets = ["ab ", "abcdeéÉßø×÷ɏɐ ▁  \n\t.,漢字🎉\u0001\x00012ﬁ", "etaoin shrdlu "]
    texts = ["".join(draw.choice(a) for _ in range(draw.randint(0, 90))) for a in alphabets for _ in range(60)]
    return [*texts, None, "", " ", "\n", "▁", "a", "漢字" * 60 + " " * 50 + "z" * 90, "the hello " * 40]


def listed(found):
    return [(list(ids), scores, [[(at, gone, tuple(new)) for at, gone, new in x] for x in further]) for ids, scores, further in found]


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_texts_encoded_together_equal_texts_encoded_alone(n, monkeypatch):
    """Ids, scores to the last bit and differences; only a part too long to be kept is searched in a loop of its own."""
    texts = odd_texts(n)
    alone, together = sentencepieces.Pieces(n_best=n), sentencepieces.Pieces(n_best=n)
    want, paths, looped = listed(map(alone.encode_all, texts)), together.paths, []
    monkeypatch.setattr(sentencepieces, "CHARS_ABREAST", 100)
    together.paths = lambda part, *rest, **more: looped.append(part) or paths(part, *rest, **more)
    assert listed(together.encode_many(texts)) == want
    assert listed(together.encode_many(texts[::-1])) == want[::-1]
    assert looped and all(len(x) > sentencepieces.LONGEST_KEPT for x in looped)


def test_cuts_of_texts_side_by_side_equal_the_splitter():
    pieces, texts = sentencepieces.Pieces(), [" " + x for x in odd_texts(7) if x]
    chars = sentencepieces.np.frombuffer(sentencepieces.wide("".join(texts)), "uint32")
    cuts = pieces._cuts(chars, sentencepieces.np.cumsum([0, *map(len, texts)])).tolist()
    assert ["".join(texts)[a:b] for a, b in itertools.pairwise(cuts)] == [x for t in texts for x in pieces.split(t)]


def test_kept_parts_take_bounded_room(monkeypatch):
    """A worker keeps at most ``TABLE`` short parts, as arrays, and the same results come with fewer."""
    monkeypatch.setattr(sentencepieces, "TABLE", 300)
    texts, few, alone = odd_texts(3), sentencepieces.Pieces(), sentencepieces.Pieces()
    for at in range(0, len(texts), 20):
        some = texts[at : at + 20]
        assert listed(few.encode_many(some)) == listed(map(alone.encode_all, some))
        own = {x for t in some for x in few.cut(t)}
        assert len(few.known.parts) <= max(300, len(own)) and not few.parts
    kept = few.known
    assert sum(x.nbytes for x in kept) < 300 * len(kept.parts)
    few.forget()
    assert not len(few.known.parts)
