"""Very long runs, very many matches, strings that weak hashes confuse, borders of thresholds."""

import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from cleargrist.llm import (
    arrays,
    decontamination,
    near_dedup,
    personal_data,
    quality_classifier,
    quality_rules,
    secret_scan,
    substring_dedup,
    token_counts,
)
from cleargrist.llm.line_dedup import LineIndex
from cleargrist.llm.queries import VOCABULARY


def thue_morse(n, letters="ab"):
    out = letters[0]
    swap = str.maketrans(letters, letters[::-1])
    while len(out) < n:
        out += out.translate(swap)
    return out[:n]


ONE = thue_morse(2048)
TWO = ONE.translate(str.maketrans("ab", "ba"))


def test_hashes_tell_thue_morse_strings_apart():
    data = np.frombuffer((ONE + TWO).encode(), np.uint8)
    at = np.array([0, len(ONE)])
    for second in (False, True):
        one, two = arrays.Hasher(data, second)(at, at + len(ONE))
        assert one != two


def test_hashes_do_not_depend_on_the_place():
    rng = np.random.default_rng(1)
    word = rng.integers(0, 256, 300).astype(np.uint8)
    size = 2 * arrays.BLOCK_BYTES + 999
    starts = np.array([0, 7, 400, arrays.BLOCK_BYTES - 150, arrays.BLOCK_BYTES + 150, 2 * arrays.BLOCK_BYTES + 3])
    data = rng.integers(0, 256, size).astype(np.uint8)
    for s in starts:
        data[s : s + 300] = word
    data[7] += 1
    for second in (False, True):
        found = arrays.Hasher(data, second)(starts[1:], starts[1:] + 300)
        alone = arrays.Hasher(word, second)(np.array([0]), np.array([300]))
        assert (found[1:] == alone).all() and found[0] != alone  # the first is partly overwritten
        short = arrays.Hasher(data[:500], second)(np.array([20]), np.array([40]))
        assert arrays.Hasher(data, second)(np.array([20]), np.array([40])) == short


def test_different_lines_do_not_add_up(frame):
    docs = frame([(i, ONE) for i in range(5)] + [(10 + i, TWO) for i in range(5)])
    cleaned = LineIndex.build(docs).clean(docs)
    assert cleaned.filter("n_dropped > 0").count() == 0


def test_different_sets_are_not_linked(frame):
    for texts in ([ONE, TWO], [f"{ONE} x y z", f"{TWO} x y z"]):
        linked = near_dedup.link_documents(frame(list(enumerate(texts))), size=4).collect()
        assert {r["component_id"] for r in linked} == {0, 1}


def test_a_different_word_is_no_hit(spark, frame):
    items = spark.createDataFrame([("i", ONE)], "item_id string, text string")
    found = decontamination.find_matches(frame([(1, TWO), (2, ONE)]), items).collect()
    assert {r["doc_id"]: sum(x["end"] - x["first"] for x in r["runs"]) for r in found} == {1: 0, 2: 1}


def test_different_lines_are_no_repeats(spark, frame):
    trees = quality_rules.fit(frame([(1, "x")]), spark.createDataFrame([], "doc_id long, quality int"))
    rated = quality_rules.rate_documents(frame([(1, f"{ONE}\n{TWO}"), (2, f"{ONE}\n{ONE}")]), trees)
    assert {r["doc_id"]: r["n_dup_lines"] for r in rated.collect()} == {1: 0, 2: 1}


def test_different_bytes_are_no_repeats(frame):
    texts = [ONE[:1500], TWO[:1500], "x" + ONE[100:1400], "yy" + TWO[90:1300] + ONE[:500]]
    left = substring_dedup.remove_repeats(frame(list(enumerate(texts))), length=1024).collect()
    expected = brute.substring_dedup(texts, 1024)
    assert {r["doc_id"]: bytes(r["kept"]) for r in left} == {i: e[3] for i, e in enumerate(expected)}


def copies_of(n, seed, words=40, edits=1):
    rng = np.random.default_rng(seed)
    base = [f"w{seed}x{i}" for i in range(words)]
    for i in range(n):
        text = list(base)
        for at in rng.integers(0, words, edits):
            text[at] = f"new{seed}x{i}"
        yield " ".join(text)


def small_blocks(monkeypatch):
    for name, size in (("BLOCK_CLASSES", 7), ("HOT_CLASSES", 20), ("BLOCK_SHINGLES", 300), ("BLOCK_SKETCHES", 5)):
        monkeypatch.setattr(near_dedup, name, size)


def test_large_families_of_several_groups(frame, monkeypatch):
    """Families cut into blocks: groups that are linked, that only come near, and chains of links."""
    small_blocks(monkeypatch)
    texts = [*copies_of(60, 1), *copies_of(40, 2), *copies_of(3, 3)]
    # Chains: each text is linked with the next one only.
    words = [f"c{i}" for i in range(400)]
    texts += [" ".join(words[i * 5 : i * 5 + 60]) for i in range(60)]
    # Texts that share a long part, but not enough of it to be linked.
    part = " ".join(f"part{i}" for i in range(45))
    texts += [f"{part} " + " ".join(f"own{i}x{j}" for j in range(14)) for i in range(50)]
    expected = brute.near_dedup(list(enumerate(texts)), 4)
    assert 40 < len({root for _, root in expected.values()}) < 120
    linked = near_dedup.link_documents(frame(list(enumerate(texts))), size=4)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in linked.collect()} == expected


def test_texts_compared_grow_with_the_family_not_its_square(frame, monkeypatch):
    small_blocks(monkeypatch)
    compare, rows = near_dedup._linked, []

    def counted(members, size, threshold):
        rows.append(members.count())
        return compare(members, size, threshold)

    monkeypatch.setattr(near_dedup, "_linked", counted)
    totals = []
    for n in (100, 400):
        rows.clear()
        linked = near_dedup.link_documents(frame(list(enumerate(copies_of(n, 5, 120)))), size=4).collect()
        assert {r["component_id"] for r in linked} == {0}
        totals.append(sum(rows))
    assert totals[1] < 5 * totals[0]


def test_turns_of_a_large_family_need_no_rounds(frame, monkeypatch):
    """What a turn links are stars: rounds of connected components run where families are made, and not again."""
    small_blocks(monkeypatch)
    find, labels = near_dedup.components, []

    def noted(edges, label):
        labels.append(label)
        return find(edges, label)

    monkeypatch.setattr(near_dedup, "components", noted)
    texts = [*copies_of(60, 7, 120), *copies_of(3, 8, 120)]
    linked = near_dedup.link_documents(frame(list(enumerate(texts))), size=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in linked} == {i: 0 if i < 60 else 60 for i in range(63)}
    assert labels == ["family"]


def near_texts(n, shared, own):
    """Texts that share a long part, but not enough of it to be linked."""
    part = " ".join(f"part{i}" for i in range(shared))
    return [f"{part} " + " ".join(f"own{i}x{j}" for j in range(own)) for i in range(n)]


def test_turns_of_a_family_end_where_they_link_little(frame, monkeypatch):
    """Pairs of near copies among texts that come near each other: in a turn only few pairs meet."""
    small_blocks(monkeypatch)
    compare, turns = near_dedup._linked, []

    def counted(members, size, threshold):
        turns.append(1)
        return compare(members, size, threshold)

    monkeypatch.setattr(near_dedup, "_linked", counted)
    texts = [f"{text}{end}" for text in near_texts(50, 48, 14) for end in ("", " twice")]
    linked = near_dedup.link_documents(frame(list(enumerate(texts))), size=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in linked} == {i: i // 2 * 2 for i in range(100)}
    assert len(turns) <= 6


def test_a_line_in_many_texts_makes_no_family(spark, frame, monkeypatch):
    """Buckets of texts that share a line and little else: only near copies among them are a family."""
    small_blocks(monkeypatch)
    tie, sizes = near_dedup.families, []

    def counted(classes, cut):
        found = tie(classes, cut)
        sizes.extend(r["count"] for r in found.groupBy("component").count().collect())
        return found

    monkeypatch.setattr(near_dedup, "families", counted)
    texts = [f"{text}{end}" for text in near_texts(100, 8, 40) for end in ("", " twice")]
    texts += [*copies_of(40, 11, 120)]
    linked = near_dedup.link_documents(frame(list(enumerate(texts))), size=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in linked} == {i: i // 2 * 2 if i < 200 else 200 for i in range(240)}
    assert sorted(sizes) == [2] * 100 + [40]


@pytest.mark.parametrize("cut", [0.05, 0.6, 0.95])
def test_rows_whose_estimate_reaches_the_cut_share_a_rare_register(cut):
    rng = np.random.default_rng(6)
    base = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (3, 20, 60, 400)]
    sets = []
    for own in base:
        for _ in range(40):
            keep = own[rng.random(len(own)) < rng.uniform(0.7, 1)]
            sets.append(np.unique(np.append(keep, rng.integers(0, 1 << 63, rng.integers(1, 1 + len(own) // 3)).astype(np.uint64))))
    own = np.array([near_dedup.registers(s) for s in sets])
    ranks = rng.integers(0, 5, near_dedup.REGISTERS << 16).astype(np.uint8)
    rows, tokens = near_dedup.rarest(own, ranks, cut)
    kept = [set(tokens[rows == i].tolist()) for i in range(len(own))]
    near = [(i, int(j)) for i in range(len(own)) for j in np.flatnonzero(near_dedup.similarity(own[i], own) >= cut)]
    assert len(near) > len(own) and all(kept[i] & kept[j] for i, j in near)
    if cut > 0.5:
        assert sum(map(len, kept)) < 0.55 * (own != near_dedup.EMPTY).sum()


BLANK_RUNS = [" " * 1_000_000, "\t" * 2_000_000, "\n" * 1_000_000, " \n" * 600_000, "　 " * 500_000]


def test_tokens_of_a_million_blanks(frame):
    encoder = token_counts._encoder(Path(VOCABULARY).read_bytes(), token_counts.PATTERN)
    texts = [run + tail for run in BLANK_RUNS for tail in ("", "word", "'s")] + ["a" + " " * 1_200_000 + "b"]
    docs = frame([(0, "ok")] + list(enumerate(texts, 1)))
    counted = token_counts.count_tokens(docs, VOCABULARY).groupBy("doc_id").agg(F.sum("n_tokens"))
    counts = dict(map(tuple, counted.collect()))
    assert counts.keys() == set(range(len(texts) + 1)) and counts[0] == 1
    for i, text in enumerate(texts, 1):
        assert encoder.sizes(text).sum() == len(text.encode())
        assert counts[i] == len(encoder.sizes(text))


def test_long_runs_are_encoded_as_short_ones_are():
    from dataclasses import replace

    encoder = token_counts._encoder(Path(VOCABULARY).read_bytes(), token_counts.PATTERN)
    eager = replace(encoder, long_run=2)
    for run in (r[:n] for r in BLANK_RUNS for n in (1, 2, 3, 7, 64, 501)):
        for text in (run, f"{run}x", f"a{run}", f"1{run} b{run}'re", f"é{run} !{run}"):
            assert eager.sizes(text).tolist() == encoder.sizes(text).tolist()


@pytest.mark.parametrize("n", [1, 255, 256, 257, 1000])
def test_offsets_of_many_matches(frame, tmp_path, n):
    text = "é" + " ".join(f"{i:024x} tok: x{i:06d}" for i in range(n)) + " password = short"
    found = secret_scan.scan_versions(frame([(1, text)]), str(tmp_path / "l"), secret_scan.BASE_RULES)
    spans = found.first()["spans"]
    listed = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)
    assert listed == brute.matches(text, brute.SECRETS)[0]


def test_a_hundred_thousand_secrets_take_seconds(frame, tmp_path):
    docs = frame([(1, "\n".join(f"{i:032x}" for i in range(100_000)))])
    secret_scan.scan_versions(frame([(1, "x")]), str(tmp_path / "w")).count()
    started = time.monotonic()
    spans = secret_scan.scan_versions(docs, str(tmp_path / "l")).first()["spans"]
    assert len(spans) == 100_000 and spans[99_999]["start"] == 33 * 99_999
    assert time.monotonic() - started < 30


def test_a_hundred_thousand_equal_words_take_seconds(spark, frame):
    text = "again " * 100_000
    items = spark.createDataFrame([("i", text), ("j", "again"), ("k", "again again")], "item_id string, text string")
    started = time.monotonic()
    found = decontamination.find_matches(frame([(1, text)]), items).first()
    assert (found["n_words"], found["longest"], found["items"]) == (100_000, 100_000, ["i", "j", "k"])
    assert time.monotonic() - started < 30


@pytest.mark.parametrize("coverage", [0.07, 0.28, 0.29, 0.5, 0.57, 0.58, 1 / 3, 0.0, 1.0])
def test_coverage_is_one_rule_for_any_number_of_blocks(spark, frame, coverage):
    from fractions import Fraction

    words = [f"w{i}" for i in range(100)]
    items = [("i", " ".join(words))] + [(f"o{i}", " ".join(f"o{i}x{j}" for j in range(12))) for i in range(9)]
    table = spark.createDataFrame(items, "item_id string, text string")
    texts = {n: " ".join(words[:n] + [f"x{i}" for i in range(100 - n)]) for n in (*range(27, 31), 33, 34, 50, 51, 56, 57, 58, 59, 100)}
    docs = frame(list(texts.items()))
    kept = [
        sorted(r["doc_id"] for r in decontamination.remove_matches(docs, table, max_coverage=coverage, block_words=n).collect())
        for n in (200_000, 30)
    ]
    share = Fraction(str(coverage))
    assert kept[0] == kept[1] == [n for n in sorted(texts) if n <= share * 100]


def test_several_blocks_of_items_scan_the_documents_once(spark, frame):
    """Only texts that may hold a window of some item are kept for the blocks."""
    items = [(f"i{i}", " ".join(f"{chr(97 + i)}{j}" for j in range(30))) for i in range(12)]
    table = spark.createDataFrame(items, "item_id string, text string")
    texts = [" ".join(f"clean{i}x{j}" for j in range(80)) for i in range(200)]
    texts += [f"intro {text} outro" for _, text in items] + [items[0][1]] * 3
    docs = frame(list(enumerate(texts)) + [(7, texts[7])])
    known = decontamination.prepared(table, "item_id", "text", 10, 60)
    assert len(list(known.packed())) > 5
    rows = decontamination.keyed(docs, "doc_id", "text")
    marked = decontamination._marked(rows, known, 10)
    assert marked.count() == len(texts) + 1
    assert 15 <= marked.filter("text is not null").count() <= 25
    several, single = (
        decontamination.find_matches(docs, table, block_words=n).drop("key").collect() for n in (60, 200_000)
    )
    assert sorted(map(repr, several)) == sorted(map(repr, single))


def test_few_labels_and_many_shards(spark, frame):
    texts = [(i, "good prose reads well" if i % 2 else "bad ### junk $$$") for i in range(8)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    scores = {}
    for shards in (1, 8):
        weights = quality_classifier.fit(frame(texts), labels, shards=shards)
        scored = quality_classifier.score_documents(frame(texts), weights)
        scores[shards] = {r["doc_id"]: r["score"] for r in scored.collect()}
        again = quality_classifier.fit(frame(texts).repartition(2), labels, shards=shards)
        assert np.array_equal(weights, again)
    for by_id in scores.values():
        assert all(score > 0.9 if i % 2 else score < 0.1 for i, score in by_id.items())


def test_training_is_that_of_a_plain_model(spark, frame):
    """One shard against the textbook's updates, one feature at a time."""
    texts = [(i, f"word{i} and {'good' if i % 2 else 'bad!'} text {i % 3}") for i in range(1, 30)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, quality int")
    weights = quality_classifier.fit(frame(texts), labels, shards=1, dims=1 << 12)
    ranked = frame(texts).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("rank"))
    ranked = ranked.join(labels, "doc_id").filter(~quality_classifier.held_out(F.col("doc_id")))
    z, n = np.zeros(1 << 12), np.zeros(1 << 12)
    alpha, beta, l1, l2 = 0.5, 1.0, 1e-4, 1e-4

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    rows = sorted(ranked.collect(), key=lambda r: r["rank"])
    for _ in range(3):
        for r in rows:
            data = np.frombuffer(r["text"].encode(), np.uint8)
            block = arrays.Block(0, data, np.array([0]), np.array([len(data)]))
            found = quality_classifier.features(block, 1 << 12)
            values = {}
            for slot, value in zip(found.slots.tolist(), found.values.tolist(), strict=True):
                values[slot] = values.get(slot, 0) + value
            p = 1 / (1 + np.exp(-sum(weight(i) * float(np.float32(v)) for i, v in values.items())))
            for i, v in values.items():
                g = (p - r["quality"]) * float(np.float32(v))
                s = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha
                z[i] += g - s * weight(i)
                n[i] += g * g
    assert np.allclose(weights, [weight(i) for i in range(1 << 12)], atol=1e-5)
    scored = quality_classifier.score_documents(frame(texts), weights).collect()
    assert all((r["score"] > 0.5) == bool(r["doc_id"] % 2) for r in scored)


@pytest.mark.parametrize(
    "text",
    [
        "look at example.com now",
        "we stayed at hotel.com",
        "meet me at cafe.de tonight",
        "prices at shop.co.uk are low; she works at example.org",
        "0 1 2 3 4 5 6 7 8 9",
        "scores: 3 1 4 1 5 9 2 6 5 3",
        "1, 2, 3, 4, 5, 6, 7, 8, 9, 1, 2",
        "| 1 | 2 | 3 |\n| 4 | 5 | 6 |",
        "a row of numbers: 5 0 0 1 0 2 0 0 1 1 0 4",
    ],
)
def test_prose_tables_and_lists_have_no_disguised_spans(text):
    assert personal_data.find_spans(text) == ([], [])


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("please write to jane at example.com today", "email", "jane at example.com"),
        ("jane2 at example.com", "email", "jane2 at example.com"),
        ("jane at example dot com", "email", "jane at example dot com"),
        ("jane at example.com is my address", "email", "jane at example.com"),
        ("jane at gmail.com", "email", "jane at gmail.com"),
        ("call 0 1 2 3 4 5 6 7 8 9", "phone", "0 1 2 3 4 5 6 7 8 9"),
        ("five 1 2 3 4 5 6 7 8 9", "phone", "five 1 2 3 4 5 6 7 8 9"),
    ],
)
def test_words_nearby_tell_disguises_from_prose(text, kind, span):
    _, more = personal_data.find_spans(text)
    assert (kind, span) in [(k, text[s:e]) for s, e, k in more]


def test_an_increment_reads_its_own_part_of_the_ledger(spark, frame, tmp_path):
    path = str(tmp_path / "ledger")
    history = [(i, f"file {i} token = abcdef{i:06d}") for i in range(300)]
    first = secret_scan.scan_versions(frame(history), path).count()
    again = [(1000, history[5][1]), (1001, "a new file with password: hunter2222")]
    found = secret_scan.scan_versions(frame(again), path).collect()
    assert first == 300 and {r["doc_id"]: len(r["spans"]) for r in found} == {1000: 1, 1001: 1}
    ledger = secret_scan.Ledger(spark, path)
    assert ledger.table().count() == 301
    blobs = spark.createDataFrame([(bytes.fromhex(r["blob"]),) for r in found], "blob binary")
    about = ledger.about(blobs)
    plan = about._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan
    assert about.count() == 2
    # Another version of a rule runs over those blobs only that are asked about.
    newer = [secret_scan.Rule("hex", r"[0-9a-f]{24,}+", version=2)]
    secret_scan.scan_versions(frame(again), path, newer)
    assert ledger.table().count() == 303


def regions_of(texts, length=40, gram=16):
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    block = arrays.Block(0, data, ends - [len(t) for t in texts], ends)
    anchor, low, high, grams, region = substring_dedup.anchors_of(block, length, gram)
    return [
        (bytes(data[a : a + gram]), bytes(data[lo : hi + length]), a - lo, int(g), int(r))
        for a, lo, hi, g, r in zip(anchor, low, high, grams, region, strict=True)
    ]


def test_names_of_regions_stand_for_their_bytes():
    """Equal names: equal bytes around equally placed anchors. Equal texts: equal names."""
    rng = np.random.default_rng(3)
    texts = [bytes(rng.choice(list(b"ab"), rng.integers(30, 300)).tolist()) for _ in range(40)]
    shared = bytes(rng.choice(list(b"abcdefgh"), 400).tolist())
    texts += [bytes(rng.choice(list(b"xyz"), k).tolist()) + shared[k : 300 + k] + b"tail" for k in range(0, 60, 3)]
    texts += [b"a" * 200, b"a" * 200, b"ab" * 90, shared, shared, b"short"]
    found = regions_of(texts)
    by_name = {}
    for gram, region, back, g, name in found:
        assert by_name.setdefault((g, name), (gram, region, back)) == (gram, region, back)
    assert regions_of([shared]) == regions_of([b"other text, long enough to have an anchor of its own", shared])[-len(regions_of([shared])) :]
    # Regions of equal bytes around equally placed anchors have one name, in every text.
    inside = {}
    for _, region, back, _, name in found:
        inside.setdefault((region, back), set()).add(name)
    assert all(len(names) == 1 for names in inside.values())


def spans_by_deobfuscation(text):
    """Without any gate."""
    base = personal_data.detect(text)
    tape = personal_data.deobfuscate(text)
    more = set()
    for start, end, kind in personal_data.detect(tape.text):
        span = (tape.starts[start], tape.ends[end - 1], kind)
        if not any(k == kind and s <= span[0] and span[1] <= e for s, e, k in base):
            more.add(span)
    return base, sorted(more, key=lambda s: (s[0], personal_data.KINDS.index(s[2]), s[1]))


def test_texts_in_other_scripts():
    import random

    rng = random.Random(4)
    pieces = ["Привет", "мир", "и", "ещё", "東京", "１２３", "٤٥٦", "a", "jane", "@", "mail.org", "mаil.org", " at ", "plus 4", "poİnt"]
    pieces += ["four", "one", "1", "７", "+４９", " ", "​", "(аt)", " dot ", "ﬁ", "ſ", "ı", "+49 30", "1.2.3.4", "²", "l", "."]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) + rng.choice(["", " ", " ", "-"]) for _ in range(rng.randint(1, 14)))
        assert personal_data.find_spans(text) == spans_by_deobfuscation(text), text


def test_prose_in_other_scripts_is_cheap():
    text = "Привет, это обычный русский текст без данных. 東京は日本の首都です。" * 20_000
    started = time.monotonic()
    assert personal_data.find_spans(text) == ([], [])
    assert time.monotonic() - started < 2
