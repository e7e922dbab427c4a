import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from codecorpus.operators import bpe
from tests.conftest import values

TEXTS = [
    "def check(x):\n    if x > 10:\n        return True\n    <if_mask>\n",
    "for i in range(10):\n    print(i, 'don''t', \"a\\tb\")\n\n\n",
    "aaaa aaa aaaaaaa aa\n abab ababab\n\tif x:\n",
    "naïve café — 東京 😀\r\n  done",
    "",
    "x" * 50 + " " * 20 + "\n",
]


def corpus(rng, n=120):
    words = ["def", "if", "return", "self", "value", "check_", "x", "y1", "aa", "aaa", "(", "):", "\n    ", "\n", " ", "==", "é"]
    return TEXTS + ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randrange(5, 60))) for _ in range(n)]


def text_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)


def library(tmp_path, texts, vocab_size, min_frequency):
    tokenizers = pytest.importorskip("tokenizers")
    path = tmp_path / "corpus.txt"
    path.write_text("".join(t + "\n" for t in texts), encoding="utf-8", newline="")
    tok = tokenizers.Tokenizer(tokenizers.models.BPE(unk_token="<unk>"))
    tok.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = tokenizers.decoders.ByteLevel()
    trainer = tokenizers.trainers.BpeTrainer(
        vocab_size=vocab_size, min_frequency=min_frequency, special_tokens=bpe.SPECIAL_TOKENS, show_progress=False
    )
    tok.train([str(path)], trainer)
    return tok


@pytest.mark.parametrize("first_pairs,max_symbols", [(512, 100_000), (8, 40), (1, 2)])
def test_same_vocabulary_and_ids_as_the_public_library(spark, tmp_path, first_pairs, max_symbols):
    texts = corpus(random.Random(first_pairs))
    tok = library(tmp_path, texts, 190, 3)
    lines = text_frame(spark, [t + "\n" for t in texts])
    vocab = bpe.learn_merges(lines, vocab_size=190, first_pairs=first_pairs, max_symbols=max_symbols)
    assert vocab.tokens == [tok.id_to_token(i) for i in range(tok.get_vocab_size())]
    probes = texts + ["unseen ЖЗ <mask><if_mask> <pad>", "<s>if x:</s>"]
    rows = bpe.encode(text_frame(spark, probes), vocab, max_len=None)
    rows = bpe.decode(rows, vocab)
    for r in rows.collect():
        want = tok.encode(probes[r.id]).ids
        assert r.input_ids == want, probes[r.id]
        assert r.decoded == tok.decode(want, skip_special_tokens=False)


def exact_merges(words: Counter, ids: dict, size: int, least: int):
    """One merge at a time, counted from scratch."""
    words = {tuple(ids[c] for c in w): n for w, n in words.items()}
    tokens = {i: c for c, i in ids.items()}
    merges = []
    while len(ids) < size:
        pairs = Counter()
        for w, n in words.items():
            for p in zip(w, w[1:]):
                pairs[p] += n
        if not pairs:
            break
        pair, n = min(pairs.items(), key=lambda kv: (-kv[1], kv[0]))
        if n < least:
            break
        text = tokens[pair[0]] + tokens[pair[1]]
        new = ids.setdefault(text, len(ids))
        tokens[new] = text
        merges.append(pair)
        merged = Counter()
        for w, n in words.items():
            out, i = [], 0
            while i < len(w):
                if w[i : i + 2] == pair:
                    out.append(new)
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            merged[tuple(out)] += n
        words = merged
    return merges


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_equal_one_merge_at_a_time(spark, seed):
    rng = random.Random(seed)
    words = Counter("".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(150))
    # Repeated words give many equal counts; each stands alone in its line.
    texts = [w for w, n in words.items() for _ in range(n)]
    vocab = bpe.learn_merges(
        text_frame(spark, texts), vocab_size=60, min_frequency=2, special=["<s>"], first_pairs=6, max_symbols=30
    )
    want = exact_merges(words, {"<s>": 0, "a": 1, "b": 2, "c": 3}, 60, 2)
    assert [(a, b) for a, b, _ in vocab.merges] == want


@pytest.mark.parametrize("first_pairs,max_symbols", [(512, 100_000), (1, 2), (4, 60)])
def test_runs_of_any_length_give_the_same_merges(spark, first_pairs, max_symbols):
    words = Counter("=" * i for i in range(2, 60))
    vocab = bpe.learn_merges(
        text_frame(spark, list(words)), vocab_size=8, min_frequency=1, special=["<s>"], first_pairs=first_pairs,
        max_symbols=max_symbols, by_line=False)
    assert [(a, b) for a, b, _ in vocab.merges] == exact_merges(words, {"<s>": 0, "=": 1}, 8, 1)


def test_windows_keep_the_whole_text(spark):
    vocab = bpe.learn_merges(text_frame(spark, TEXTS), vocab_size=80, min_frequency=2)
    rows = bpe.encode_windows(text_frame(spark, ["abc def " * 30, ""]), vocab, max_len=7).orderBy("id", "window").collect()
    whole = bpe.encode(text_frame(spark, ["abc def " * 30]), vocab).first().input_ids
    assert [x for r in rows if r.text for x in r.input_ids][: len(whole)] == whole
    assert all(len(r.input_ids) == 7 for r in rows) and [r.window for r in rows if not r.text] == [0]


def test_pair_counts_and_words(spark):
    words = bpe.word_frequencies(text_frame(spark, ["a b  b\n\nb", "a"]), "text")
    assert dict(values(words, "word", "n")) == {"a": 2, " b": 2, " ": 1, "\n": 2, "b": 1}
    by_line = bpe.word_frequencies(text_frame(spark, ["a\n  b\n"]), "text", by_line=True)
    assert dict(values(by_line, "word", "n")) == {"a": 1, "\n": 2, " ": 1, " b": 1}
    pairs = bpe.pair_counts(spark.createDataFrame([([1, 2, 1, 2], 3), ([5], 9)], "symbols array<int>, n bigint"))
    assert values(pairs, "left", "right", "n") == [(1, 2, 6), (2, 1, 3)]


def test_tables_round_trip_and_lengths(spark):
    vocab = bpe.learn_merges(text_frame(spark, TEXTS), vocab_size=80, min_frequency=2)
    again = bpe.Vocabulary.from_tables(vocab.tokens_df(spark), vocab.merges_df(spark))
    assert (again.tokens, again.merges) == (vocab.tokens, vocab.merges)
    with pytest.raises(ValueError):
        bpe.Vocabulary.from_tables(vocab.tokens_df(spark), vocab.merges_df(spark), limit=3)
    pairs = text_frame(spark, TEXTS).select("id", F.col("text").alias("input_text"), F.lit("if x:").alias("target_text"))
    for r in bpe.prepare_pairs(pairs, vocab, 16, 8).collect():
        assert len(r.input_ids) == len(r.attention_mask) == 16 and len(r.labels) == 8
        assert all(m == (i != bpe.PAD_ID) for i, m in zip(r.input_ids, r.attention_mask))
    short = bpe.encode(text_frame(spark, ["abc " * 30]), vocab, max_len=5, pad=False).first()
    assert len(short.input_ids) == 5
    skipped = bpe.decode(bpe.encode(text_frame(spark, ["<s>if<pad>"]), vocab), vocab, skip_special=True).first()
    assert skipped.decoded == "if"
    checks = bpe.validate_tokenizer(text_frame(spark, TEXTS), vocab).first()
    assert checks.texts == len(TEXTS) == checks.round_trips and checks.with_mask_token == 1


def test_merging_many_words_equals_one_word_at_a_time():
    import random

    import pyarrow as pa

    rng = random.Random(3)
    for _ in range(60):
        ranks, size = {}, 4
        for rank in range(8):
            pair, known = (rng.randrange(size), rng.randrange(size)), rank == 7
            if pair not in ranks:
                ranks[pair] = (rank, 2 if known else size)
                size += not known
        words = [[rng.randrange(rng.choice([2, 4])) for _ in range(rng.choice([0, 1, 2, 5, 12]))] for _ in range(50)]
        batch = pa.record_batch([pa.array(words, pa.list_(pa.int32())), pa.array([1] * len(words))], ["symbols", "n"])
        symbols, word, _ = bpe._flat(batch)
        symbols, word = bpe._merged(symbols, word, ranks)
        assert [symbols[word == i].tolist() for i in range(len(words))] == [bpe.merge_symbols(w, ranks) for w in words]


def test_a_batch_asks_for_each_distinct_word_once():
    import pyarrow as pa

    asked = []

    def of(word):
        asked.append(word)
        return list(word.encode())

    rows = pa.array([["a", "bc", "a"], None, [], ["bc"] * 500, [""]], pa.list_(pa.string()))
    got = bpe._encoded(rows.slice(0), of).to_pylist()
    assert got == [[97, 98, 99, 97], None, [], [98, 99] * 500, []] and sorted(asked) == ["", "a", "bc"]
    assert bpe._encoded(rows.slice(2, 2), of).to_pylist() == [[], [98, 99] * 500]
