"""Each operator against brute force on small tables: nulls, empty and very long texts, ties,
repeated rows, empty tables and extra columns with clashing names."""

import base64
import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labeltext.llm import (
    fm_index,
    jaccard_join,
    language_id,
    main_text,
    mixing,
    pii,
    secrets,
    suffix_trees,
    top_k,
    warc_bundles,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _documents():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)] + ["É", "ß", "naïve", "Ünï"]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, rows = prose(40), []
    for k in range(120):
        text = prose(rng.randint(1, 80))
        if k % 3 == 0:
            text = prose(20) + "\n" + passage + "\t" + prose(20)
        rows.append([k, text, "en", "src0", len(text)])
    original = prose(60)
    for k in range(40):
        words = original.split()
        for _ in range(k % 5):
            words[rng.randrange(60)] = rng.choice(vocabulary)
        rows.append([200 + k, " ".join(words), "de", "src1", 1])
    rows += [[300 + k, original, "de", "src1", 1] for k in range(30)]
    rows += [
        [400, None, None, None, None], [401, "", "en", "", 0], [402, " \n\t ", "en", "x", 3],
        [403, "One", "en", "x", 3], [404, "one", "en", "x", 3], [405, prose(30_000), "en", "x", 9],
        [406, original.upper(), "en", "x", 9], [407, "x" * 50_000, "en", "x", 9],
    ]
    return rows


ROWS = _documents()


@pytest.fixture(scope="module")
def docs(spark):
    # Columns that the operators make themselves come as extra ones.
    extra = {
        name: F.lit("extra")
        for name in ("key", "n", "component_id", "places", "spans", "items", "score", "weight",
                     "topic", "rid", "cls", "_rows_")
    }
    return spark.createDataFrame(ROWS, DOCS).repartition(5).withColumns(extra)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _words(text):
    return WORD.findall(text or "")


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _components(rows):
    sets = {}
    for doc, text in rows:
        w = _words((text or "").translate(LOWER))
        sets[doc] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {doc: (len(sets[doc]), find(doc)) for doc in sets}


def test_near_duplicates_equal_brute_force(docs, monkeypatch):
    want = _components([(r[0], r[1]) for r in ROWS])
    for block, slice_ in ((jaccard_join.BLOCK, jaccard_join.SLICE), (7, 5)):
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        monkeypatch.setattr(jaccard_join, "SLICE", slice_)
        got = {r[0]: (r[1], r[2]) for r in jaccard_join.near_duplicates(docs).collect()}
        assert got == want


def test_one_document_of_each_group_stays(docs, empty):
    want = _components([(r[0], r[1]) for r in ROWS])
    kept = jaccard_join.drop_near_duplicates(docs.unionAll(docs.where("doc_id = 3")))
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(
        d for d, (_, c) in want.items() if c == d
    )
    assert jaccard_join.drop_near_duplicates(empty).count() == 0


def test_each_text_of_a_repeated_id_is_judged_alone(spark):
    prose = lambda seed: " ".join(random.Random(seed).choices([f"v{k}" for k in range(99)], k=60))
    a, b, c, d = map(prose, range(4))
    rows = [(3, a), (5, a), (5, b), (6, c), (6, c + " more"), (6, c), (None, b), (None, d), (None, d), (7, None), (7, " ")]
    table = spark.createDataFrame([(k, t, {"k": "v"}) for k, t in rows], "doc_id long, text string, _set map<string,string>")
    table = table.withColumnRenamed("_set", "extra").repartition(3)
    kept = jaccard_join.drop_near_duplicates(table).collect()
    left = sorted((str(r.doc_id), r.text or "") for r in kept)
    assert left in (
        sorted([("3", a), ("5", b), ("6", six), ("None", d), ("7", ""), ("7", " ")]) for six in (c, c + " more")
    )


def _complements(many):
    """Thue-Morse words: many equal halves, and sums of powers that agree."""
    word = "a"
    while len(word) < many:
        word += word.translate(str.maketrans("ab", "ba"))
    return word[:many], word[:many].translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("many", [1024, 2048, 1500])
def test_different_long_words_stay_different(spark, many):
    one, two = _complements(many)
    line = " ".join(f"n{k}" for k in range(6))
    rows = [(1, f"{line} {one} {line}"), (2, f"{line} {two} {line}")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.n_removed for r in suffix_trees.drop_repeats(table).collect()] == [0, 0]
    short = spark.createDataFrame([(1, f"w x {one} y z"), (2, f"w x {two} y z")], "doc_id long, text string")
    found = jaccard_join.near_duplicates(short).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 2)}
    item = spark.createDataFrame([(9, two)], "item_id long, text string")
    hits = {r.doc_id: r.n_hit for r in fm_index.contamination(table, item).collect()}
    assert hits == {1: 0, 2: 1}


def test_null_ids_link_but_name_nothing(spark):
    text = " ".join(f"a{k}" for k in range(30))
    rows = [(None, text), (9, text), (None, None), (4, text), (4, text)]
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(str, got.select("doc_id", "component_id").collect())) == sorted(
        f"Row(doc_id={d}, component_id={c})" for d, c in [(None, 4), (9, 4), (None, None), (4, 4), (4, 4)]
    )


@pytest.mark.parametrize("size", [1_000_000, 1000])
def test_repeats_equal_brute_force(docs, size, monkeypatch):
    if size == 1000:  # branches that don't fit are shared by tasks
        plan = suffix_trees._plan
        monkeypatch.setattr(suffix_trees, "_plan", lambda counts, size: plan(counts, 20))
    first = {}
    for doc, text, *_ in sorted(ROWS, key=lambda r: r[0]):
        w = _words(text)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), doc)
    got = {r[0]: tuple(r)[1:4] for r in suffix_trees.drop_repeats(docs, size=size).collect()}
    assert len(got) == len(ROWS)
    for doc, text, *_ in ROWS:
        w = _words(text)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < doc:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert got[doc] == (len(w), sum(gone), _sha(kept))


def test_contamination_equals_brute_force(spark, docs, empty):
    rng = random.Random(1)
    texts = [r[1] for r in ROWS if r[1]]
    items = [(k, " ".join(rng.choice(texts).split()[3:25])) for k in range(30)]
    items += [(50, "One"), (51, None), (52, ""), (53, "w1 w2"), (53, "w3, W4"), (None, "w1")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = defaultdict(set)
    for name, text in items:
        w = word.findall((text or "").translate(LOWER))
        for k in range(max(1, len(w) - 9) if w else 0):
            phrases[tuple(w[k : k + 10])] |= set() if name is None else {str(name)}
    sizes = {len(p) for p in phrases}
    want = {}
    for doc, text, *_ in ROWS:
        w = word.findall((text or "").translate(LOWER))
        hit, names = [False] * len(w), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in phrases:
                    names |= phrases[tuple(w[k : k + size])]
                    hit[k : k + size] = [True] * size
        want[doc] = (len(w), sum(hit), len(names), _sha(",".join(sorted(names))), any(hit))
    for block in (2_000_000, 60):
        rows = fm_index.contamination(docs, benchmark, block=block).collect()
        assert {r[0]: tuple(r)[1:6] for r in rows} == want
        clean = fm_index.drop_contaminated(docs, benchmark, block=block)
        assert clean.columns == docs.columns
        assert {r[0] for r in clean.select("doc_id").collect()} == {d for d, x in want.items() if not x[4]}
    assert fm_index.contamination(empty, benchmark).count() == 0
    assert fm_index.contamination(docs, benchmark.limit(0)).where("contaminated").count() == 0


def test_phrases_are_found_whatever_the_size_of_a_shard(monkeypatch):
    """Chunks of a few rows and shards from one chunk to all of them give the same spans."""
    rng = np.random.default_rng(3)
    rows = [" ".join(rng.choice(["ab", "cd", "ef", "gh", "zz"], rng.integers(0, 30))) for _ in range(80)]
    phrases = fm_index.Phrases([("x", "ab cd ef gh ab"), ("y", "cd"), ("z", "")], 3)
    want = set()
    for row, text in enumerate(rows):
        words = text.split()
        for phrase in ("ab cd ef", "cd ef gh", "ef gh ab", "cd"):
            n = len(phrase.split())
            want |= {(row, k, k + n) for k in range(len(words)) if words[k : k + n] == phrase.split()}
    cut = fm_index.batch_words
    monkeypatch.setattr(fm_index, "batch_words", lambda *args: cut(*args, 150))
    for size in (1, 40, 10_000):
        found = [x[:3] for x in phrases.occurrences(pa.array(rows), size)]
        assert len(found) == len(want) and set(found) == want


def test_fm_index_finds_every_occurrence():
    text = np.random.default_rng(0).integers(1, 4, 500)
    index = fm_index.FMIndex(text, 2)
    for size in (1, 2, 5):
        phrases = np.unique(np.lib.stride_tricks.sliding_window_view(text, size), axis=0)
        low, high = index.search(phrases)
        for phrase, a, b in zip(phrases, low, high, strict=True):
            found = sorted(index.locate(np.arange(a, b)).tolist())
            assert found == [k for k in range(len(text) - size + 1) if (text[k : k + size] == phrase).all()]


SECRETS = [
    (1, 'Password = "abcdefgh12", token: short'), (2, "see AKIAABCDEFGHIJKL23 and AKIASHORT"),
    (3, "0123456789abcdef0123456789abcdef01"), (4, None), (5, ""),
    (6, "key zX9kQ2vB7nM4tR8wL1yH6pD3 end"), (7, "id 123e4567-e89b-12d3-a456-426614174000"),
    (8, "release-notes-version-2024-01-12"), (9, "paſſword=abcdefghij Token=a.b.c"),
    (10, "\U0001f600 secret: token=abcdefghijk"), (None, "x" * 40_000 + " q9" * 9000),
]


def test_secrets(spark, empty):
    rows = secrets.find_secrets(spark.createDataFrame(SECRETS, "doc_id long, text string")).collect()
    got = {r["doc_id"]: r for r in rows}
    spans = {k: r["spans"] for k, r in got.items()}
    assert spans == {
        1: "assign:0:22", 2: "access:4:22", 3: "hex:0:34", 4: "", 5: "", 6: "random:4:28",
        7: "", 8: "", 9: "", 10: "assign:2:27", None: "",
    }
    assert got[6]["base_sha256"] == _sha("") and got[1]["base_sha256"] == _sha("assign:0:22")
    assert secrets.find_secrets(empty).count() == 0


def test_secrets_joined_to_words_are_found(spark):
    """Random keys alone and inside paths, query strings and compound names; words, digests
    and UUIDs in such places are none."""
    rng = random.Random(6)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    around = [
        ("", ""), ("/services/production/webhooks/notifications/", ""), ("deploy-production-signing-key-", ""),
        ("https://example.com/v1/callback?customer_reference=", "&page=2"), ("/archive/", "/download/attachments/original"),
    ]
    rows = []
    for size in (16, 18, 20, 24, 32):
        for before, after in around:
            for _ in range(40):
                key = rng.choice("0123456789") + "".join(rng.choices(letters, k=size - 1))
                key = key[1:size // 2] + key[0] + key[size // 2:]
                rows.append((before, key, f"see {before}{key}{after} end"))
    harmless = [
        "/services/production/items/123e4567-e89b-12d3-a456-426614174000/attachments",
        "backup-production-database-2024-01-12-10-30-45", "/usr/lib/x86_64-linux-gnu/libexample2",
        "/objects/sha1/0123456789ABCDEF0123456789ABCDEF01234567/raw", "user_profile_page2_section14",
    ]
    texts = [r[2] for r in rows] + harmless
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(table).collect()}
    whole = 0
    for k, (_, key, text) in enumerate(rows):
        at = text.index(key)
        spans = [list(map(int, s.split(":")[1:])) for s in got[k].split(",") if s.startswith("random")]
        whole += any(a <= at and at + len(key) <= b for a, b in spans)
    assert whole >= 0.97 * len(rows)
    assert [got[len(rows) + k] for k in range(len(harmless))] == [""] * len(harmless)


def test_redaction_keeps_all_else(spark):
    rows = [(k, t, len(t) if t else None, "z") for k, t in SECRETS]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, other string")
    got = {r[0]: r for r in secrets.redact_secrets(table).collect()}
    assert got[2]["text"] == "see [SECRET] and AKIASHORT" and got[2]["n_chars"] == len(got[2]["text"])
    assert got[4]["text"] is None and got[8]["text"] == SECRETS[7][1] and got[8]["other"] == "z"
    for kind in ("int", "string", "double", None):
        other = table.drop("n_chars") if kind is None else table.withColumn("n_chars", F.col("n_chars").cast(kind))
        again = secrets.redact_secrets(other)
        assert again.schema == other.schema
        assert {r[0]: r["text"] for r in again.collect()} == {k: r["text"] for k, r in got.items()}


VECTORS = "vec_id long, embedding array<float>, rank int"


def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    values = rng.normal(scale=0.3, size=(300, 16)).astype(np.float32)
    values[50:90] = values[40]
    rows = [(int(k), v.tolist(), 1) for k, v in enumerate(values)]
    bad = [(1000, None, 1), (1020, [None, 1.0], 1), (1040, [float("nan")], 1), (1060, [float("inf")], 1)]
    for shard in (8192, 64):
        monkeypatch.setattr(top_k, "SHARD", shard)
        got = top_k.top_k(spark.createDataFrame(rows + bad + [(1080, [], 1)], VECTORS)).collect()
        points = np.floor(64 * values.astype(float)).astype(np.int64)
        ids = np.append(np.arange(300), 1080)
        points = np.vstack([points, np.zeros((1, 16), np.int64)])
        want = []
        for q in np.flatnonzero(ids % 20 == 0):
            score = points @ points[q]
            order = [k for k in np.lexsort((ids, -score)) if k != q][:20]
            want += [(int(ids[q]), n + 1, int(ids[k]), int(score[k])) for n, k in enumerate(order)]
        assert sorted(map(tuple, got)) == sorted(want)
    assert top_k.top_k(spark.createDataFrame([], VECTORS)).count() == 0
    assert top_k.top_k(spark.createDataFrame(rows[:1], VECTORS)).count() == 0


def test_archives_round_trip(spark):
    pages = [
        (5, "http://a", "<p>one"), (2, "http://b\r\nX: y", "<p>one"), (7, None, None), (6, "u", ""),
        (8, "http://c", "é" * 400_000), (2, "http://b", "<p>one"), (9, "u", "line\r\n\r\nWARC/1.1\r\n\r\n"),
        (None, "u", "<p>one"), (None, "v", "alone"),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    table = table.withColumn("digest", F.lit(1)).withColumn("refers", F.lit(1))
    got = sorted(map(tuple, warc_bundles.archive(table).drop("url").collect()), key=str)
    first = {}
    for page, _, text in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(text or "", page)
    want = []
    for page, _, text in pages:
        data = (text or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        least = first[text or ""]
        again = page != least
        want.append((page, len(data), digest, "revisit" if again else "response",
                     least if again else None, "" if again else text or ""))
    assert got == sorted(want, key=str)
    assert warc_bundles.archive(table.limit(0)).count() == 0
    small = warc_bundles.archive(table, min_bytes=7).where("record_type = 'revisit'").count()
    assert small == 0


def test_bundle_frames_stand_alone():
    import zstandard

    writer = warc_bundles.Writer()
    for k in range(3):
        writer.add(str(k), bytes([65 + k]) * 200_000)
    index = list(writer.index)
    data = writer.finish()
    frames = warc_bundles.read_seek_table(data)
    for name, frame, start, size in index:
        at, packed = frames[frame]
        plain = zstandard.ZstdDecompressor().decompress(data[at : at + packed])
        assert plain[start : start + size] == bytes([65 + int(name)]) * 200_000


def test_main_text(spark):
    pages = [
        (1, "u", "<html><head><title>T</title></head><body><nav><a href=x>Home</a></nav><article>"
         "<h1>T &amp; U</h1><p>one\n two<br>three<p class='ad'>buy<p>last</article><footer>f</footer>"),
        (2, "u", None), (3, None, ""), (4, "u", "plain"),
        (5, "u", "<div class='menu'>m</div><div><p>The body of the page, long enough.</p></div>"
         "<div id='comments'><p>me too</p></div><script>var a='<p>no</p>'</script>"),
        (6, "u", "<article>" + "<p>x y</p>" * 20_000 + "</article>"),
    ]
    rows = main_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    text = {r["page_id"]: r["text"] for r in rows}
    assert text[1] == "T & U\n\none two three\n\nlast"
    assert (text[2], text[3], text[4]) == ("", "", "plain")
    assert text[5] == "The body of the page, long enough."
    assert text[6] == "\n\n".join(["x y"] * 20_000)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


SENTENCE = "A sentence of some length, which says in many plain words what the page is about. "


def test_main_text_loses_no_block_of_the_article():
    read = main_text.main_text
    long = SENTENCE * 3
    article = [
        "<h1>Head</h1>", "<p>by line</p>", f"<p>{long}</p>",
        "<table><tr><td>a</td></tr><tr><td>b</td></tr></table>",
        f"<div class='ad'>buy {long}</div>", "<p>After it.</p>",
        "<section><h2>Two</h2><p>Short.</p></section>", "<p>See <a href=x>this one</a></p>", "<p>End.</p>",
    ]
    want = ["Head", "by line", long.strip(), "a", "b", "After it.", "Two", "Short.", "See this one", "End."]
    menu = "".join(f"<li><a href=x>place {k}</a></li>" for k in range(6))
    comments = f"<div class='comments'><p>{long * 20}</p></div>"
    for before, after in [
        ("", ""), ("<article>", "</article>"), ("<main>", "</main>"),
        ("<div class='search-page social'>", "</div>"), ("<div id='header'><article>", "</article></div>"),
        ("<div class='has-comments'>", "</div>"),
    ]:
        page = f"<body><ul>{menu}</ul>{before}{''.join(article)}{after}{comments}<ul>{menu}</ul></body>"
        assert read(page).split("\n\n") == want, before
    # A long wrapper without a heading or a mark stays if its name is doubtful only.
    assert read(f"<div class='social'><p>{long}</p></div><p>x</p>").startswith("A sentence")
    assert read(f"<div class='comments'><p>{long}</p></div><p>x</p>") == "x"


def test_main_text_surges_on_marked_pages():
    read = main_text.main_text
    long = SENTENCE * 3
    teaser = "<article><h2>Next</h2><p>Short.</p></article>"
    between = "<p>Tuesday</p><p>By line</p><p>Four minutes</p>"
    article = f"<article><p>Lead.</p><p>{long}</p><p>End.</p></article>"
    want = ["Lead.", long.strip(), "End."]
    # What stands apart and never surges is no article; what a window still reaches is.
    assert read(teaser + between + article + between + teaser).split("\n\n") == want
    assert read(f"{article}<p>By line</p>{teaser}").split("\n\n") == [*want, "Next", "Short."]
    # Two articles apart that surge both stay, and so does a short one if nothing surges higher.
    assert read(article + between + article).split("\n\n") == want * 2
    assert read(between + teaser + between).split("\n\n") == ["Next", "Short."]


def test_main_text_surges_against_brute_force():
    py = random.Random(3)
    for _ in range(300):
        lengths = [py.choice([0, 0, 0, 1, 9, 50, 120]) for _ in range(py.randrange(30))]
        sums = [sum(lengths[k : k + main_text.WINDOW]) for k in range(len(lengths))]
        assert main_text.block_sums(lengths) == sums
        level = max(1, min(main_text.SURGE, max(sums, default=0)))
        want, k = [], 0
        while (start := next((j for j in range(k, len(sums)) if sums[j] >= level), None)) is not None:
            last = max([j + 1 for j in range(start) if not sums[j]], default=0)
            k = next((j for j in range(start, len(sums)) if not sums[j]), len(sums))
            want.append((last, start, k))
        assert main_text.regions(lengths) == want


def test_main_text_repeated_rows_and_other_columns(spark):
    schema = "page_id long, url string, html string, text long, n_chars string"
    rows = [(1, "u", "<p>x", 5, "a")] * 2 + [(None, None, "<p>y", None, None)]
    got = main_text.extract(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "u", "x", 1)] * 2 + [(None, None, "y", 1)], key=str
    )
    assert main_text.extract(spark.createDataFrame([], schema)).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _base_pii(text):
    out, counts = [], []
    for kind, pattern in PATTERNS.items():
        found = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits)))
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and total % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            found += [f"{kind}:{m.start()}:{m.end()}"] if good else []
        out += found
        counts.append(len(found))
    return (*counts, _sha(",".join(out)))


def test_personal_data_equals_brute_force(spark, empty):
    texts = [
        None, "", "a@b.c_x@d.e 1.2.3.4 300.1.1.1 4111 1111 1111 1111 +1 (017) 555-7713",
        "\U0001f600 x.y@z.com\n4111-1111-1111-1112 " + "7" * 30, "1 " * 4000 + "a.b" * 3000,
        " 1.1.1.1" * 700, "+123456789 +12345678 +1-2", "call (555) 123-4567 or j (at) mail.com",
        "@a.b.c a@b", "1.2.3.4.5.6.7.8 010.001.1.1", "é+é@é.é 9" + "@" * 50,
    ]
    table = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, email int")
    rows = pii.find_personal_data(table, pii.Forest()).collect()
    assert {r[0]: tuple(r)[1:6] for r in rows} == {k: _base_pii(t) for k, t in enumerate(texts)}
    assert all(r["n_model"] == 0 for r in rows)
    assert pii.personal_data(empty).count() == 0
    forest = pii.Forest([(1, 5.0, -1.0, 2.0)], [1.0], {"number": 0.5})
    more = {r[0]: r["spans"] for r in pii.find_personal_data(table, forest).collect()}
    assert more[7] == "number:5:19"


def test_pii_learns_from_all_documents(spark):
    n = 21_000
    k = F.col("id")
    text = F.when(k % 2 == 0, F.format_string("host 10.0.%d.%d", (k / 256).cast("int") % 256, k % 256))
    docs = spark.range(n).select(k.alias("doc_id"), text.otherwise(F.format_string("host 10.0.%d.999", k)).alias("text"))
    rows = pii.training_rows(docs).groupBy("kind", "label").count().collect()
    assert {(r["kind"], r["label"], r["count"]) for r in rows} >= {("ip", 1.0, n // 2), ("ip", 0.0, n // 2)}
    forest = pii.train(docs)
    assert len(forest.trees) == len(forest.weights) == pii.TREES and "number" in forest.thresholds
    assert pii.train(docs.where("doc_id % 2 = 0")) == pii.Forest()


def test_language_model_is_exact_and_learns(spark, empty):
    rng = np.random.default_rng(2)
    scores, move = rng.normal(size=(7, 2)), rng.normal(size=(2, 2))
    old, language_id.BLOCK = language_id.BLOCK, 3
    got = language_id.marginals(scores, move, np.array([0, 5, 7]))
    language_id.BLOCK = old
    import itertools

    want = np.zeros_like(scores)
    for a, b in ((0, 5), (5, 7)):
        for path in itertools.product(range(2), repeat=b - a):
            steps = sum(move[x, y] for x, y in itertools.pairwise(path))
            weight = np.exp(steps + sum(scores[a + k, y] for k, y in enumerate(path)))
            for k, y in enumerate(path):
                want[a + k, y] += weight
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True))

    def moves(weights):
        """Expected moves and the log of the summed weights, over all paths."""
        count, total = np.zeros((2, 2)), 0.0
        for a, b in ((0, 5), (5, 7)):
            paths = list(itertools.product(range(2), repeat=b - a))
            each = np.array([
                sum(weights[x, y] for x, y in itertools.pairwise(path))
                + sum(scores[a + k, y] for k, y in enumerate(path)) for path in paths
            ])
            total += np.log(np.exp(each).sum())
            for path, share in zip(paths, np.exp(each) / np.exp(each).sum(), strict=True):
                for x, y in itertools.pairwise(path):
                    count[x, y] += share
        return count, total

    for block in (1, 2, 3, 64):
        old, language_id.BLOCK = language_id.BLOCK, block
        expected = language_id.forward_backward(scores, move, np.array([0, 5, 7]), moves=True)[1]
        language_id.BLOCK = old
        assert np.allclose(expected, moves(move)[0])
    # The expected moves are the slopes of the log partition sum.
    for x, y in itertools.product(range(2), repeat=2):
        step = np.zeros((2, 2))
        step[x, y] = 1e-6
        slope = (moves(move + step)[1] - moves(move - step)[1]) / 2e-6
        assert np.isclose(slope, expected[x, y], atol=1e-6)

    # Words of two languages in one text are told apart by their own marginals.
    py = random.Random(8)
    made = {"en": ["th", "ing", "and", "whe"], "de": ["sch", "ung", "keit", "zw"]}

    def words(lang, n):
        return ["".join(py.choices(made[lang], k=3)) for _ in range(n)]

    known = [("en", "de")[k % 2] for k in range(200)]
    model = language_id.fit([" ".join(words(lang, 20)) for lang in known], known)
    right = total = 0
    for _ in range(50):
        truth, mixed = [], []
        for lang in py.sample(["en", "de", "en", "de"], 4):
            n = py.randrange(4, 12)
            truth += [lang] * n
            mixed += words(lang, n)
        emit = model.emissions(language_id.letters(" ".join(mixed)))
        chance = language_id.marginals(emit, model.move, np.array([0, len(mixed)]))
        right += sum(model.languages[k] == t for k, t in zip(chance.argmax(axis=1), truth, strict=True))
        total += len(mixed)
    assert right >= 0.95 * total

    stems = {"en": ["th", "ing", "and"], "fr": ["eau", "ou", "é"], "de": ["sch", "ü", "ung"]}
    py = random.Random(4)
    rows = []
    for k in range(150):
        lang = ["en", "fr", "de"][k % 3]
        rows.append((k, " ".join("".join(py.choices(stems[lang], k=3)) for _ in range(20)), lang))
    rows += [(900, None, "en"), (901, "12 !", "en"), (902, "sch " * 30_000, None), (None, "the", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r[0]: r for r in language_id.language_id(table).collect()}
    assert all(found[k]["lang_pred"] == lang for k, _, lang in rows[:150])
    assert found[900]["lang_pred"] == found[901]["lang_pred"] == "und" and found[902]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert language_id.language_id(empty).count() == 0
    nothing = language_id.language_id(table.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_mixing_meets_the_margins(docs, empty):
    rows = mixing.weigh(docs, mixing.Targets())
    assert rows.count() == len(ROWS)
    total = rows.agg(F.sum("n_tokens")).first()[0]
    for column, shares in (("source_group", mixing.Targets().source), ("topic", mixing.Targets().topic)):
        got = {r[0]: r[1] / total for r in rows.groupBy(column).agg(F.sum(F.expr("n_tokens * weight"))).collect()}
        there = sum(shares[k] for k in got)
        if column == "topic":  # the margin raked last holds to the digit
            assert all(abs(v - shares[k] / there) < 1e-9 for k, v in got.items())
    expected = rows.agg(F.sum(F.expr("n_tokens * keep_probability"))).first()[0]
    assert expected <= 0.5 * total + 1e-6
    assert mixing.weigh(empty, mixing.Targets()).count() == 0


def test_drawn_tokens_meet_all_margins(spark):
    """Cells that have to count several times, in a draw with the parameters in use."""
    rng = random.Random(8)
    rows = []
    for k in range(6000):
        size = 20 if k % 3 == 0 else 700 if k % 3 == 1 else 100
        lang = rng.choice(["en"] * 12 + ["de", "fr", "es", "xx"])
        text = "a " * size + ("| b" if k % 20 == 0 else "License" if k % 20 == 1 else "###" if k % 20 == 2 else "")
        rows.append((k, text, lang, f"src{rng.randrange(21)}"))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = mixing.Targets()
    got = mixing.draw(table.withColumn("copy", F.lit("extra")), targets).cache()
    total = table.agg(F.sum(mixing.tokens())).first()[0]
    drawn = got.agg(F.sum("n_tokens")).first()[0]
    assert abs(drawn / total - 0.5) < 0.02
    for column, shares in zip(("source_group", "lang_group", "topic"), targets.margins().values(), strict=True):
        found = {r[0]: r[1] / drawn for r in got.groupBy(column).agg(F.sum("n_tokens")).collect()}
        there = sum(shares[k] for k in found)
        assert all(abs(v - shares[k] / there) < 0.015 for k, v in found.items()), (column, found)
    assert got.where("copy > 0").count() and got.count() == got.select("doc_id", "copy").distinct().count()


def test_targets_that_cannot_be_met_are_reported(spark):
    rows = [(1, "a b", "en", "src0"), (2, "a b", "de", "src1")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    with pytest.warns(UserWarning, match="source_group src0"):
        mixing.draw(table, mixing.Targets()).count()


def test_calibrated_probabilities_keep_the_share():
    size, weight = np.array([10.0, 100.0, 50.0]), np.array([9.0, 0.5, 1.0])
    chance = mixing.calibrate(weight, size, 0.5, 200)
    assert chance.max() <= 1 and abs((size * chance).sum() / size.sum() - 0.5) < 1e-9


def test_queries_equal_their_sql(spark):
    from labeltext.llm.oracle import ORACLE
    from labeltext.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    for name, sql in ORACLE.items():
        got, want = QUERIES[name](spark, folder), con.sql(sql)
        names = sorted(got.columns)
        assert names == sorted(want.columns)
        lines = [
            sorted(map(str, rows))
            for rows in (map(tuple, got.select(names).collect()), want.select(*names).fetchall())
        ]
        assert lines[0] == lines[1], name


def test_pipeline(spark, docs, empty):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    table = spark.createDataFrame(ROWS, DOCS)
    for source in (table, empty):
        step = source
        for name, stage in corpus_pipeline.STAGES:
            before, step = step, stage(spark, step, folder)
            if name != "mix":
                assert step.columns == before.columns
        assert step.count() <= source.count()
    assert corpus_pipeline.run(spark, folder).count() > 0
