"""Parts of the operators: bounds, hot groups, external paths, trained models, stages."""

import random
import time
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from quillon.llm import blocks, bpe, common, components, decontaminate, html_text, induced_sort, language_id, line_dedup, line_quality, quality_cnn, simhash, suffix_dedup, token_counts


def test_decontaminate_in_blocks(spark, odd_docs, folder):
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    want = sorted(decontaminate.scan(odd_docs, bench).collect(), key=repr)
    assert sorted(decontaminate.scan(odd_docs, bench, block_bytes=200).collect(), key=repr) == want


def test_decontaminate_removal(spark, odd_docs, folder):
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    seen = decontaminate.scan(odd_docs, bench)
    clean = seen.filter(f"{seen.columns[-3]} = '[]'").count()
    kept = decontaminate.decontaminate(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == clean
    spans = decontaminate.decontaminate(odd_docs, bench, remove="spans")
    assert spans.columns == odd_docs.columns and spans.count() == odd_docs.count()
    docs = [("A blue, RING here", 3), ("x blue x ring", 4)]
    df = spark.createDataFrame([(i, t) for t, i in docs], "doc_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.decontaminate(df, bench, remove="spans").collect()}
    assert got == {3: "A  here", 4: "x blue x ring"}


def test_simhash_dense_bucket(spark, small):
    want = sorted(tuple(r) for r in simhash.near_duplicates(small).select("doc_id", "component_id").collect())
    assert sorted(tuple(r) for r in simhash.near_duplicates(small, bucket=1).select("doc_id", "component_id").collect()) == want


@pytest.mark.parametrize("bucket", [1, 20, 300])
def test_simhash_dense_tries_are_joined_in_cells(spark, bucket):
    r = random.Random(bucket)
    centre = r.getrandbits(64)
    fps = sorted({centre ^ sum({1 << r.choice((r.randrange(64), 3, 60, r.randrange(20))) for _ in range(r.randrange(5))}) for _ in range(900)})
    reps = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, rep long").repartition(3)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 2:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    want = {i: find(i) for i in range(len(fps)) if find(i) != i}
    got = {r.node: r.component for r in components.components(simhash.links(reps, bucket)).collect()}
    assert {k: v for k, v in got.items() if k != v} == want


def test_trie_links_are_all_close_pairs():
    r = random.Random(5)
    centre = r.getrandbits(64)
    keys = np.array(sorted({(centre & ~0xFFFFFFFF) | ((centre ^ sum(1 << r.randrange(32) for _ in range(r.randrange(4)))) & 0xFFFFFFFF) for _ in range(300)}), dtype=np.uint64)
    x, y = simhash.trie_links(keys, np.array([0, len(keys)]))
    got = {tuple(sorted(p)) for p in zip(x.tolist(), y.tolist())}
    want = {(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys)) if (int(keys[i]) ^ int(keys[j])).bit_count() <= 2}
    assert got == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99), (5, 5), (101, 100)], "u long, v long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys((99, 100, 101), 99)}


def test_keep_one(spark, odd_docs):
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    named = [i for i in ids if i is not None]
    assert len(named) == len(set(named))
    wanted = {d for d, _, c in brute.op2([(r.doc_id, r.text) for r in odd_docs.collect()]) if d is not None and d == c}
    assert set(named) == wanted


def test_line_dedup_hot_and_calm(spark, odd_docs):
    want = sorted(line_dedup.dedup_lines(odd_docs).collect(), key=repr)
    assert sorted(line_dedup.dedup_lines(odd_docs, hot=1).collect(), key=repr) == want
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns
    assert out.filter("n_chars <> char_length(text)").count() == 0


def test_line_dedup_is_native(spark, odd_docs):
    plan = line_dedup.dedup_lines(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=60), st.sampled_from([0, 40, 1 << 26]), st.sampled_from([3, 50]))
def test_induced_sort(symbols, ram, cap):
    text = np.array([*symbols, 0], dtype=np.uint16)
    got = [(int(p), int(c)) for pos, lcp in induced_sort.InducedSort(text, cap, ram).suffixes() for p, c in zip(pos, lcp)]
    whole = text.tolist()
    assert sorted(p for p, _ in got) == list(range(len(whole)))
    for (a, _), (b, c) in zip(got, got[1:]):
        x, y = whole[a:], whole[b:]
        common = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert min(c, cap) == min(common, cap)
        assert common >= cap or x < y


def test_suffix_dedup_on_disk(spark, monkeypatch):
    r = random.Random(8)
    base = ["".join(r.choice("ab \n") for _ in range(150)) for _ in range(3)]
    docs = [(r.choice([None, *range(12)]), base[r.randrange(3)][r.randrange(80) :] + "ab" * r.randrange(60) + base[r.randrange(3)][: r.randrange(150)]) for _ in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for ram in (2000, 1 << 26):
        out = suffix_dedup.dedup(df, finish=suffix_dedup._digest, fields="n_bytes long, n_removed long, n_spans long, kept_sha256 string", ram=ram)
        assert sorted((tuple(x) for x in out.collect()), key=repr) == sorted(brute.op3(docs), key=repr)


def test_shards_in_batches():
    r = random.Random(6)
    blocks_in = []
    for _ in range(3):
        pieces = ["".join(r.choice("ab") for _ in range(r.randrange(8, 14))).encode() for _ in range(40)]
        anchors = np.array([int(p[4:7] == b"aba") for p in pieces], dtype=np.uint64)
        blocks_in.append((np.array([len(p) for p in pieces], dtype=np.uint32), np.array([r.randrange(50) for _ in pieces], dtype=np.int64), anchors, b"".join(pieces)))
    low = {}
    for sizes, docs, anchors, data in blocks_in:
        ends = np.cumsum(sizes).tolist()
        for a, z, d, g in zip([0, *ends], ends, docs.tolist(), anchors.tolist()):
            for i in range(a, z - 7):
                low[g, data[i : i + 8]] = min(low.get((g, data[i : i + 8]), 99), d)
    want = []
    for sizes, _, anchors, data in blocks_in:
        ends = np.cumsum(sizes).tolist()
        want.append([low[g, data[i : i + 8]] for a, z, g in zip([0, *ends], ends, anchors.tolist()) for i in range(a, z - 7)])
    for batch, ram in ((1, 1 << 26), (1 << 20, 1 << 26), (1 << 20, 500)):
        got = [x.tolist() for x in suffix_dedup.shard_minima(blocks_in, length=8, ram=ram, batch=batch)]
        if batch == 1:  # one anchor at a time: windows of other anchors do not count
            assert got == want
        else:
            assert all(a <= b for x, y in zip(got, want) for a, b in zip(x, y))


def hot_blocks(n_blocks, pieces, seed=9):
    """Blocks of pieces that all have one anchor, with some equal windows in them."""
    r = random.Random(seed)
    gram = b"aabbccddabcdabcddca"
    some_bytes = lambda: bytes(r.choices(b"abcd", k=31))
    tails = [some_bytes() for _ in range(300)]
    out = []
    for _ in range(n_blocks):
        some = [r.choice((some_bytes(), r.choice(tails))) + gram + r.choice((some_bytes(), r.choice(tails))) for _ in range(pieces)]
        some += [some[0][: r.randrange(50, 81)] for _ in range(3)] + [gram + b"e" * 31 + b"e" * r.randrange(30) for _ in range(5)]
        docs = np.array([r.randrange(-50, 10**6) for _ in some], dtype=np.int64)
        out.append((np.array([len(p) for p in some], dtype=np.uint32), docs, np.full(len(some), 7, dtype=np.uint64), b"".join(some)))
    return out


def spooled(blocks_in, room, **limits):
    spool, sizes = blocks.Spool(room), []
    for n, docs, grams, data in blocks_in:
        spool.add(blocks.squeeze(n, docs.view(np.uint64), np.diff(grams, prepend=np.uint64(0)), tail=data))
        sizes.append((len(data), len(data) - 49 * len(n)))
    return suffix_dedup.spooled_minima(spool, sizes, **limits)


def test_a_hot_anchor_is_split_exactly():
    given_ = hot_blocks(3, 40)
    low = {}
    cuts = []
    for sizes, docs, _, data in given_:
        ends = np.cumsum(sizes.astype(int)).tolist()
        cuts.append([(data[i : i + 50], d) for a, z, d in zip([0, *ends], ends, docs.tolist()) for i in range(a, z - 49)])
        for w, d in cuts[-1]:
            low[w] = min(low.get(w, d), d)
    want = [[low[w] for w, _ in c] for c in cuts]
    for ram, batch in ((1 << 16, 1 << 12), (2000, 400)):
        assert [x.tolist() for x in spooled(given_, 1000, ram=ram, batch=batch)] == want
        assert [x.tolist() for x in suffix_dedup.shard_minima(given_, ram=ram, batch=batch)] == want


def test_no_sort_of_a_hot_anchor_gets_more_than_a_batch(monkeypatch):
    ram, batch, seen = 1 << 14, 1 << 12, []

    def note(pieces, docs, length, ram):  # in place of the sort
        seen.append(sum(map(len, pieces)))
        return np.repeat(docs, [len(p) - length + 1 for p in pieces])

    monkeypatch.setattr(suffix_dedup, "sorted_minima", note)
    given_ = hot_blocks(4, 250)
    assert sum(len(b[3]) for b in given_) > 4 * ram
    for got in (list(spooled(given_, 0, ram=ram, batch=batch)), suffix_dedup.shard_minima(given_, ram=ram, batch=batch)):
        assert [len(x) for x in got] == [len(b[3]) - 49 * len(b[0]) for b in given_]
    assert max(seen) <= batch


@given(st.lists(st.binary(max_size=20), max_size=20))
@settings(max_examples=30, deadline=None)
def test_blocks_round_trip(items):
    assert blocks.unsqueeze_strings(blocks.squeeze_strings(items)) == items
    a, b = np.arange(len(items), dtype=np.uint32), np.arange(3, dtype=np.uint64) << np.uint64(40)
    (x, y), tail = blocks.unsqueeze(blocks.squeeze(a, b, tail=b"end"))
    assert x.tolist() == a.tolist() and y.tolist() == b.tolist() and tail == b"end"


def test_bpe_decode_and_clashing_columns(spark, odd_docs):
    coded = bpe.encode(odd_docs)
    assert coded.columns == [c for c in odd_docs.columns if c != "text"] + ["ids"]
    back = bpe.decode(coded)
    want = sorted(((r.doc_id, r.text or "") for r in odd_docs.collect()), key=repr)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=repr) == want
    row = bpe.decode(coded.select("ids", F.lit("x").alias("text")).limit(1)).first()
    assert row["text"] == "x" and row["_text"] is not None


def test_bpe_small_chunks(spark, odd_docs, monkeypatch):
    narrow = odd_docs.select("doc_id", "text")
    want = sorted((tuple(r) for r in bpe.encode(narrow).collect()), key=repr)
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 200)
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 10)
    assert sorted((tuple(r) for r in bpe.encode(narrow).collect()), key=repr) == want


def test_bucket_counts_of_any_corpus(spark, small, monkeypatch):
    for size in (0, 10**9, 10**13, 10**14, 10**15):
        monkeypatch.setattr(blocks, "text_bytes", lambda docs, n=size: n)
        n = blocks.buckets(small, most=bpe.MOST_BUCKETS)
        assert n <= bpe.MOST_BUCKETS < 100_000 and blocks.key_buckets(n) <= blocks.MOST_KEY_BUCKETS
        assert blocks.buckets(small) >= size / blocks.BUCKET_BYTES


def test_bpe_and_suffix_dedup_at_the_most_buckets(spark, odd_docs, monkeypatch):
    """A corpus of 10 TB has the most buckets there are; here these are few, and reached by few bytes."""
    narrow = odd_docs.select("doc_id", "text")
    want = sorted((tuple(r) for r in bpe.encode(narrow).collect()), key=repr)
    kept = sorted((tuple(r) for r in suffix_dedup.dedup(narrow).collect()), key=repr)
    monkeypatch.setattr(blocks, "text_bytes", lambda docs: 10**13)
    monkeypatch.setattr(bpe, "MOST_BUCKETS", 40)
    monkeypatch.setattr(bpe, "KNOWN", 20)
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(blocks, "MOST_KEY_BUCKETS", 7)
    monkeypatch.setattr(suffix_dedup, "ASKED", 50)
    assert sorted((tuple(r) for r in bpe.encode(narrow).collect()), key=repr) == want
    assert sorted((tuple(r) for r in suffix_dedup.dedup(narrow).collect()), key=repr) == kept


def test_long_words_as_short_ones():
    ranks = bpe.load_ranks(bpe.default_vocabulary()[0])
    r = random.Random(2)
    for n in (2, 30, 64, 65, 400):
        w = "".join(r.choice("ethionr ") for _ in range(n)).encode()
        assert bpe._encode_long(w, ranks) == bpe.encode_word(w, ranks) or len(bpe.encode_word(w, ranks)) == 1


def test_html_blocks_and_training():
    crf = html_text.trained()
    wrong = total = 0
    for page, labels in html_text.training_pages(80, seed=77):
        got = crf.decode([b.features for b in html_text.blocks(page)])
        wrong += sum(a != b for a, b in zip(got, labels))
        total += len(labels)
    assert wrong / total < 0.02
    page = "<title>no</title><header><p>Site name</p></header><article><h1>One</h1><p>Two &lt;b&gt; three,<br>four.<p><b>Five</b>six.<aside><h3>Related</h3><ul><li><a href=x>Link</a></ul></aside><div class=comments><p>Nice, I like it.</p></div></article><footer>&copy; Me</footer><script>var a = '<p>x</p>'"
    assert html_text.main_text(page, crf) == "One Two <b> three, four. Fivesix."
    assert html_text.main_text("<", crf) == html_text.main_text(None, crf) == ""


def test_line_crf_keeps_prose_and_drops_noise():
    crf = line_quality.trained()
    prose = "\n".join("This is an ordinary sentence number with some more words in it." + c for c in "abcdefgh").encode()
    noise = "\n".join(f"home{c} | about | contact | login | search | news | more | all" for c in "abcdefgh").encode()
    assert line_quality.measure(prose, crf)[-2] > 0.9
    assert line_quality.measure(noise, crf)[-2] < 0.1


def labelled(spark):
    at = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{at}/documents.parquet")
    return docs, spark.read.parquet(f"{at}/labels.parquet")


def test_quality_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    known = docs.join(labels, "doc_id").select("doc_id", "text", "quality").collect()
    held = [r for r in known if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    net = quality_cnn.train(docs, labels, rows=1500)
    right = sum((net.score(r.text.encode()) >= quality_cnn.THRESHOLD) == bool(r.quality) for r in held)
    assert right / len(held) > 0.94


def test_quality_sample_passes_over_texts_that_do_not_fit(spark, monkeypatch):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    first = labels.selectExpr("doc_id", "xxhash64(doc_id) as h").orderBy("h").first().doc_id
    rows = [(i, "x" * 5000 if i == first else f"text {i}") for i in ids] + [(ids[-1], f"text {ids[-1]}")] * 3
    got = []
    monkeypatch.setattr(quality_cnn.ByteCNN, "fit", lambda self, rows: got.extend(rows) or self)
    quality_cnn.train(spark.createDataFrame(rows, "doc_id long, text string"), labels, most_bytes=2000)
    assert sorted(t for t, _ in got) == sorted(f"text {i}".encode() for i in ids if i != first)


def test_line_quality_against_labels(spark):
    docs, labels = labelled(spark)
    out = line_quality.judge(docs.join(labels, "doc_id").select("doc_id", "text", "quality"))
    counts = {(r.quality, r.kept): r["count"] for r in out.filter("not base_failed").groupBy("quality", "kept").count().collect()}
    assert counts[(1, True)] / (counts[(1, True)] + counts.get((1, False), 0)) > 0.99
    assert counts[(0, False)] / (counts[(0, False)] + counts.get((0, True), 0)) > 0.9


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.identify(docs, language_id.train(docs)).filter("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1")
    assert out.filter("lang = lang_pred").count() / out.count() > 0.97


def test_language_sample_is_bounded(spark, small):
    few, all_ = language_id.train(small, rows=20), language_id.train(small)
    assert 0 < len(few.words.keys) < len(all_.words.keys)
    assert len(language_id.train(small, most_bytes=20_000).words.keys) < len(all_.words.keys)
    assert language_id.train(small.limit(0)).langs == []


def test_words_are_runs_of_letters(spark):
    texts = ["² ½ Ⅷ ① 12 _", "x² aⅧb ª ʰ", "Ünï漢字 co-op don't", "", None]
    assert [language_id.words(t) for t in texts] == [[], ["x", "a", "b", "ª", "ʰ"], ["ünï漢字", "co", "op", "don", "t"], [], []]
    spark_words = spark.createDataFrame([(t,) for t in texts[:3]], "t string").selectExpr(r"regexp_extract_all(lower(t), '\\p{L}+', 0) as w").collect()
    assert [r.w for r in spark_words] == [language_id.words(t) for t in texts[:3]]
    scorer = language_id.Scorer(language_id.Model({"en": {"x": 3}}))
    assert scorer.predict("² ½ Ⅷ") == ("und", 0.0) and scorer.predict("² x")[0] == "en"


def test_language_scores_against_a_plain_version(small, monkeypatch):
    monkeypatch.setattr(language_id, "_CACHE", 50)  # words are forgotten again and again
    model = language_id.train(small)
    scorer = language_id.Scorer(model)
    for r in small.collect():
        found = [w for w in language_id.words(r.text)]
        total = np.zeros(len(model.langs))
        for w in found:
            if w in model.words.keys:
                total += model.words.matrix[model.words.keys[w]]
                continue
            padded, got = f"^{w}$", []
            for i in range(len(padded)):
                got += [model.gram_rows[model.grams[padded[i : i + n]]] for n in range(language_id.LONGEST, 0, -1) if padded[i : i + n] in model.grams][:1]
            total += np.mean(got, axis=0) if got else 0
        want = ("und", 0.0)
        if found:
            chance = np.exp((total - total.max()) * min(1, language_id.EVIDENCE / len(found)))
            want = (model.langs[int(np.argmax(total))], chance.max() / chance.sum())
        got = scorer.predict(r.text)
        assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-9


def test_long_words_are_scored_whole():
    model = language_id.Model({"de": {"xyz": 3}, "en": {"abc": 3}})
    ends, bulk = "abc" * 20, "xyz" * 400
    word = ends + bulk + ends + bulk + ends  # its ends and its middle are not like the most of it
    assert len(word) // 2 in range(len(ends + bulk), len(ends + bulk + ends))
    scorer = language_id.Scorer(model)
    assert scorer.predict(word)[0] == "de" and scorer.predict(ends + "q")[0] == "en"
    assert not any(len(w) > language_id._LONG for w in scorer.at)
    padded, rows = f"^{word}$", []
    for i in range(len(padded)):
        rows.append(next((model.gram_rows[model.grams[padded[i : i + n]]] for n in range(language_id.LONGEST, 0, -1) if padded[i : i + n] in model.grams), None))
    assert np.allclose(model.unseen([word])[0], np.mean([x for x in rows if x is not None], axis=0))


JOINING = r"(?i:'s|'t|'re|'ve|'m|'ll|'d)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"


@pytest.mark.parametrize(("pattern", "margin"), [(None, token_counts.MARGIN), (None, None), (JOINING, token_counts.MARGIN), (JOINING, None), (r"\p{L}+|\p{N}+(?=x*y)", None)])
def test_token_edits_at_random(monkeypatch, pattern, margin):
    path, own = bpe.default_vocabulary()
    counter = token_counts.Counter(path, token_counts.checked(pattern or own))
    r = random.Random(4)
    alphabet = " \t\n'srevtmldLab09ß漢.,!?🙂  \n\nxxy"
    some = lambda k: "".join(r.choice(alphabet) for _ in range(r.randint(0, k)))
    monkeypatch.setattr(token_counts, "SEGMENT", 4)
    for turn in range(250):
        text = some(60) + (" " * r.randint(0, 40) + "\n" * r.randint(0, 3) + some(40)) * (turn % 3)
        tree = token_counts.TokenTree(text, counter, margin)
        for _ in range(5):
            a = r.randint(-2, len(text) + 2)
            b, new = a + r.randint(-1, 12), some(20)
            start = min(max(a, 0), len(text))
            text = text[:start] + new + text[min(max(b, start), len(text)) :]
            tree.edit(a, b, new)
            whole = token_counts.TokenTree(text, counter, margin)
            assert (tree.text, tree.total, tree.chars[1]) == (text, whole.total, len(text))
            assert tree.leaves == whole.leaves  # the segments, not only their sum


def test_token_edits_touch_little():
    counter = token_counts.Counter(*bpe.default_vocabulary())
    text = "some words of a long text, and a line.\n" * 30_000
    tree = token_counts.TokenTree(text, counter)
    for i in range(200):
        tree.edit(5000 * i, 5000 * i + 3, "xyz")
    assert tree.encoded < 200 * 20
    assert sum(x is not None for x in tree.texts) < 0.7 * len(tree.texts)
    assert tree.total == token_counts.TokenTree(tree.text, counter).total


def test_patterns_that_cannot_be_cut_anew():
    for pattern in (r"(?<=a)b", r"\bword\b", r"\s*", "^a"):
        with pytest.raises(ValueError):
            token_counts.checked(pattern)


@pytest.mark.parametrize("unit", ["a", "a.", "a@", "@a", "a@b", "a@b.", "1 ", "1", "(", "+1 ", "1.", "-", " "])
def test_redactions_are_linear(unit):
    began = time.thread_time()
    token_counts.redactions(unit * (1_000_000 // len(unit)))
    assert time.thread_time() - began < 8  # a quadratic one takes many minutes


def test_redactions_and_clashing_names(spark):
    assert token_counts.redactions("a@b@c.de, x.y+z@q.org! +1 555 123 4567, 10.0.0.1") == [(40, 48, "[NUMBER]"), (23, 38, "[NUMBER]"), (10, 21, "[EMAIL]"), (2, 8, "[EMAIL]")]
    docs = spark.createDataFrame([(1, "mail a@b.cd", "x", "y")], "doc_id long, text string, edits string, edited string")
    out = token_counts.with_redactions(docs)
    assert out.columns[-1] == "_edits"
    row = token_counts.count_tokens(out, edits="_edits").first()
    assert (row.edits, row.n_edits) == ("x", 1)
    edits = spark.createDataFrame([(1, 1, 0, 4, "Post")], "doc_id long, nr int, start int, stop int, text string")
    row = token_counts.count_tokens(token_counts.with_edits(docs, edits), edits="_edits").first()
    assert (row.edited, row.n_edits) == ("y", 1)


def test_token_edits_from_a_table(spark, odd_docs):
    edits = spark.createDataFrame([(11, 1, 0, 4, "Mail"), (11, 2, 0, 0, None), (99, 1, 0, 0, "x")], "doc_id long, nr int, start int, stop int, text string")
    out = token_counts.count_tokens(token_counts.with_edits(odd_docs.select("doc_id", "text"), edits))
    got = {r.doc_id: r.n_edits for r in out.collect()}
    assert got[11] == 2 and got[7] == 0


def test_pipeline_against_its_brute_force_version(spark, tmp_path):
    at = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{at}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{at}/benchmark.parquet").collect()]
    scorer = language_id.Scorer(language_id.train(docs))
    rows = []
    for r in docs.collect():
        pred, score = scorer.predict(r.text)
        if pred != "und" and score >= language_id.MIN_SCORE:
            rows.append((r.doc_id, r.text))
    rows = [(d, t if len(k) == len(t.split("\n")) else "\n".join(k)) for (d, t), k in zip(rows, brute.line_drops(rows))]
    rows = [x for x, (d, _, c) in zip(rows, brute.op2(rows)) if d == c]
    rows = [x for x, hit in zip(rows, brute.op1(rows, items)) if not hit[-1]]
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, at).collect()}
    assert got == {d: brute.sha(t) for d, t in rows}


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_pipeline_leaves_no_inner_tables(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 0
    left = [p.name for p in tmp_path.iterdir() if p.name.startswith("quillon")]
    assert len(left) == 1, left


def test_pipeline_empty(spark, empty_folder):
    assert corpus_pipeline.run(spark, empty_folder).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_names(name):
    assert name
