"""Token files, phrases and the prefix trie against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labeltext.llm import phrases, prefix_trie, token_files

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(token_files.vocabulary())
    found.encode_special_tokens = True
    return found


def _ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [token_files.END]


def _mixed_texts(many):
    rng = random.Random(8)
    marks = ["a", "b's", "é", "ß", " ", "  ", "\n", "\r\n", "\t", " ", " ", "　", "\x85",
             "\x1c", "12", "!", "日", "\U0001f600", " '", "я", "<|endoftext|>"]
    return ["".join(rng.choices(marks, k=rng.randint(0, 14))) for _ in range(many)]


def test_parts_encode_as_whole_texts(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_PARTS", 50)
    monkeypatch.setattr(token_files, "ENCODE_BYTES", 3000)
    encoder = token_files.Encoder(token_files.vocabulary())
    assert encoder.splits
    texts = [*_mixed_texts(4000), None, "", "x" * 30_000, "word " * 5000]
    for text, raw in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(raw, encoder.kind).tolist() == _ids(tokenizer, text), repr(text)
    whole = token_files.Encoder(token_files.vocabulary("word_bpe_49k.json"))
    assert not whole.splits and len(list(whole.encode(pa.array(["A b", None])))) == 2


def test_token_archive_round_trip(spark, tokenizer, tmp_path):
    rows = [(k, t) for k, t in enumerate(_mixed_texts(300), start=-40)]
    rows += [(None, "no id"), (None, None), (7, "repeated"), (7, "repeated"), (10**12, "z " * 20_000)]
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    docs = docs.withColumns({c: F.lit("x") for c in ("tie", "frame", "size", "start", "file")})
    folder = token_files.write_archive(docs, token_files.vocabulary(), str(tmp_path / "archive"))
    got = token_files.read_archive(spark, folder, with_ids=True).orderBy("start").collect()
    by_text = Counter((k, tuple(_ids(tokenizer, t))) for k, t in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == by_text
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)
    start = 0
    for r in got:
        assert r.start == start and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    wanted = spark.createDataFrame([(7,), (10**12,), (-1,), (5555,)], "doc_id long")
    found = Counter((r.doc_id, tuple(r.ids)) for r in token_files.lookup(spark, folder, wanted).collect())
    assert found == Counter({k: n for k, n in by_text.items() if k[0] in (7, 10**12, -1)})


def test_token_archive_files(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text {k} of many words") for k in range(500)], "doc_id long, text string")
    folder = token_files.write_archive(docs, token_files.vocabulary(), str(tmp_path / "archive"))
    dictionary = (tmp_path / "archive" / "dictionary").read_bytes()
    shards = list((tmp_path / "archive").glob("*.ids"))
    assert shards and dictionary
    for shard in shards:
        assert shard.read_bytes()[8:40] == hashlib.sha256(dictionary).digest()
    (tmp_path / "archive" / "dictionary").write_bytes(dictionary + b"x")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_archive(spark, folder).collect()
    # A document stands alone: its frame and the dictionary are enough.
    store, path = token_files._store(str(shards[0]))
    shard = token_files.Shard(store, path, dictionary)
    ids, null, at, size, many = shard.index()
    data = shards[0].read_bytes()[at[-1] : at[-1] + size[-1]]
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress(data)
    assert len(plain) == 2 * many[-1] and not null.any()


def test_empty_token_archive(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    folder = token_files.write_archive(docs, token_files.vocabulary(), str(tmp_path / "archive"))
    assert token_files.read_archive(spark, folder).count() == 0
    assert token_files.lookup(spark, folder, docs).count() == 0


def _phrases(rows, least, longest, first):
    """Plain counting of every run of words."""
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, found in counts.items():
        found = {p: f for p, f in found.items() if f >= least}
        kept = []
        for p, a in found.items():
            if len(p) < 2 or any(
                f >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, f in found.items()
            ):
                continue
            cuts = [(1000 * a * sizes[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:first], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("block", [300, 3_000_000])
def test_phrases_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
    monkeypatch.setattr(phrases, "BIN_PHRASES", 200)
    rng = random.Random(5)
    some = ["the", "The", "of", "État", "new", "york", "a", "x y", "0"]
    rows = []
    for _ in range(250):
        parts = rng.choices([*some, "new york", "the state of the art"], k=rng.randint(0, 30))
        text = "".join(p + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "?!"]) for p in parts)
        rows.append((text, rng.choice(["en", "fr", None, "und"])))
    rows += [(None, "en"), ("", "en"), (" \t.,\r\n", None), ("solo", "xx"), ("aa " * 3000, "aa"), ("q " * 7, "aa")]
    rows += [("copied text of five words here", "en")] * 40
    table = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    table = table.withColumns({c: F.lit(1) for c in ("block", "place", "at", "word", "n", "id", "doc_id")})
    got = phrases.collocations(table, least=6, longest=5, first=25)
    assert sorted(map(tuple, got.collect())) == _phrases(rows, 6, 5, 25)


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(empty).count() == 0
    rare = spark.createDataFrame([("each word once", None)], "text string, lang string")
    assert phrases.collocations(rare).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right, n = 10**15 + 7, 10**15 + 9, 10**16 + 1, 10**17 - 3
    none = "array<bigint>"
    level = spark.createDataFrame(
        [(["p", "q"], "en", a, [left], [right])],
        f"words array<string>, lang string, f long, heads {none}, tails {none}",
    ).select(F.array(F.lit(1)).cast(none).alias("ids"), "*")
    row = phrases.scored(spark.createDataFrame([("en", n)], "lang string, n long"), [None, level]).first()
    assert (row.a, row.l, row.r, row.score) == (a, left, right, 1000 * a * n // (left * right))


def _trie(rows):
    """The trie with whole sequences as names."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turn_ = (role or "", text or "")
            name = f"{len(turn_[0].encode())}:{turn_[0]}{turn_[1]}".encode()
            talks[conv].append(((turn is not None, turn or 0, hashlib.sha256(name).digest()), turn_))
    talks = {c: [t for _, t in sorted(v)] for c, v in talks.items()}
    whole = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(talks.get(c - c % 5, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = set()
    for node, convs in members.items():
        under = [q for q in members if q[: len(node)] == node]
        ends = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(node))))
        out.add((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(q) == len(node) + 1 for q in under),
            sum(not any(r[:-1] == q for r in members if r) for q in under),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def test_trie_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS", 8)
    monkeypatch.setattr(prefix_trie, "HOT_PARENTS", 20)
    rng = random.Random(6)
    says = [("user", "hi"), ("user", "hé"), (None, "x"), ("bot", None), ("", ""), ("user", "")]
    rows = []
    for c in [*range(150), 10**12, 10**12 + 1]:
        for turn in range(rng.choice([1, 2, 3, 9, 12])):
            rows.append((c, turn, *rng.choice(says[: rng.choice([1, 2, 6])])))
    # One conversation that many others equal, one whose base isn't there, ties, nulls, repeats.
    rows += [(c, t, "user", "same") for c in range(1000, 1100) for t in range(3)]
    rows += [(2003, t, "user", f"t{t}") for t in range(2)]
    rows += [(3000, None, "a", "b"), (3000, 1, "a", "c"), (3000, 1, "a", "b"), (3000, 1, "a", "b")]
    rows += [(None, 0, "user", "lost")] + [(4000, t, "user", "long " * 50) for t in range(60)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    table = table.withColumns({c: F.lit("x") for c in ("node", "depth", "place", "digest", "bytes", "parent")})
    got = prefix_trie.trie(table).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == _trie(rows)


def test_empty_trie(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(empty).count() == 0
