"""Each operator against a brute-force version, an exact round trip or its
accuracy on held-out rows."""

import hashlib
import math
import os
import random
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tablewright.llm import decontam_qgram, license_scan, mix_wfq, pii_bootstrap, prefix_counts, quality_llr, simhash_anchor, token_files, word_tokens
from tablewright.llm.common import documents
from tablewright.llm.queries import QUERIES, TOKENIZER
from tablewright.session import scratch_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = "ab'stre lvmd\n\t  ,.!<|éÉ̸́= \x1c\x85ΣßİK中文กำ½²1Ⅷ👍‍"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in documents(spark, SF).select("doc_id", "text").collect()}


def odd_texts(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        x = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 24)))
        if rng.random() < 0.3:
            x += rng.choice(["<|endoftext|>", "<|startoftext|>"]) + x[::-1]
        yield x


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


# --- 1: decontamination ---------------------------------------------------
def nearest(patterns, text):
    """Edits of the substring of ``text`` nearest to each of ``patterns``
    (equally long): the plain table of edits, a row of it at a time."""
    text, patterns = np.frombuffer(text, np.uint8), np.array([list(p) for p in patterns])
    at = np.arange(len(text) + 1)
    row = np.zeros((len(patterns), len(text) + 1), dtype=int)
    for column in patterns.T:
        best = row + 1
        best[:, 1:] = np.minimum(best[:, 1:], row[:, :-1] + (column[:, None] != text))
        row = np.minimum.accumulate(best - at, axis=1) + at
    return row.min(axis=1)


def regions(item):
    m = min(decontam_qgram.REGION, len(item))
    return [item[s : s + m] for s in range(len(item) - m + 1)]


def test_decontamination_against_alignment_of_all_pairs(spark, texts):
    rng = random.Random(7)
    items = [(r.item_id, r.text) for r in documents(spark, SF, "benchmark").limit(6).collect()]
    docs = []
    for i in range(24):
        item = list(items[i % 6][1])
        for _ in range(i):  # from none to too many edits
            at = rng.randrange(len(item))
            item[at : at + 1] = rng.choice([[], ["x"], [item[at], "y"]])
        body = texts[rng.choice(list(texts))][:300]
        docs.append((i, body + " " + "".join(item) + " " + body[::-1]))
    docs += [(100 + i, t[:600]) for i, t in enumerate(list(texts.values())[:6])]
    norm = {d: bytes(decontam_qgram.normalised([t]))[:-1] for d, t in docs}
    pats = {i: bytes(decontam_qgram.normalised([t]))[:-1].rstrip(b" ") for i, t in items}
    want = {(d, i) for d, t in norm.items() for i, p in pats.items() if min(nearest(regions(p), t)) <= decontam_qgram.edit_budget(len(regions(p)[0]))}
    found = decontam_qgram.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want and 6 < len(want) < 30


def test_decontamination_finds_planted_items_and_blocks_agree(spark, texts):
    bench = documents(spark, SF, "benchmark")
    flat = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = {r.item_id: flat(r.text) for r in bench.collect()}
    want = {(d, i) for d, t in texts.items() for i, x in items.items() if x in flat(t)}
    got = {(r.doc_id, r.item_id) for r in decontam_qgram.contaminated(documents(spark, SF), bench).collect()}
    assert want and want <= got
    in_blocks = decontam_qgram.contaminated(documents(spark, SF), bench, block_chars=2000)
    assert {(r.doc_id, r.item_id) for r in in_blocks.collect()} == got


def test_regions_of_a_long_item_in_many_short_texts(texts):
    item = " ".join(re.findall(r"[^\W_]+", " ".join(list(texts.values())[:8]).lower()))[:4000].strip()
    index = decontam_qgram.BenchmarkIndex([(7, item)])
    docs, held = [], set()
    for s in range(0, len(item) - decontam_qgram.REGION, 50):
        docs += ["tiny", item[s : s + decontam_qgram.REGION].upper(), ""]
        held.add(len(docs) - 2)
    assert {r[0] for r in decontam_qgram.find_regions(index, docs)} == held


def test_a_region_is_found_at_every_place_of_an_item(texts):
    item = " ".join(re.findall(r"[^\W_]+", " ".join(list(texts.values())[:2]).lower()))[:330].strip()
    index = decontam_qgram.BenchmarkIndex([(7, item)])
    docs = ["zq" + item[s : s + decontam_qgram.REGION].strip() + "zq" for s in range(len(item) - decontam_qgram.REGION + 1)]
    whole = {i for i, d in enumerate(docs) if len(d) == decontam_qgram.REGION + 4}
    assert len(whole) > 150 and whole <= {r[0] for r in decontam_qgram.find_regions(index, docs) if r[2] == 0}


def test_edits_of_the_nearest_region_over_every_start(texts):
    rng = random.Random(11)
    item = " ".join(re.findall(r"[^\W_]+", " ".join(list(texts.values())[2:4]).lower()))[:150].strip()
    index, m = decontam_qgram.BenchmarkIndex([(7, item)]), decontam_qgram.REGION
    docs, want = [], {}
    for i in range(24):
        s = rng.randrange(len(item) - m - 5)
        part = list(item[s : s + m + rng.randrange(6)])
        for _ in range(rng.randrange(4, 13)):
            at = rng.randrange(len(part))
            part[at : at + 1] = rng.choice([[], ["x"], [part[at], "y"]])
        docs.append("qj" + "".join(part) + "jq")
        norm = bytes(decontam_qgram.normalised([docs[-1]]))[:-1]
        codes = bytes(index.codes[0])
        edits = min(nearest([codes[p : p + m] for p in range(len(codes) - m + 1)], norm))
        if edits <= decontam_qgram.edit_budget(m):
            want[i] = edits
    assert {r[0]: r[2] for r in decontam_qgram.find_regions(index, docs)} == want and 5 < len(want) < 24


# --- 2: licences ----------------------------------------------------------
def test_license_scan_against_all_places(spark):
    rng = random.Random(3)
    bits = ["GNU", "General", "Public", "License", "apache", "CC", "by", "MIT", "nc", "4.0", "version", "3", "Licensed under the", "word", "é", "-", ", "]
    docs = [(i, " ".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    docs.append((999, "This work is licensed under the GNU General Public License, version 3. Cc-By, MIT license"))
    got = {r.doc_id: r for r in license_scan.license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for d, text in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        places = [(i, label) for phrase, label in license_scan.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        r, starts = got[d], [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        notices = {label for label, _, keys in license_scan.NOTICES if all(f" {k} " in f" {' '.join(words)} " for k in keys)}
        assert set(r.labels.split(",")) - {""} <= notices | {x for _, x in places} and (r.score > 0) == bool(r.labels)
    assert got[999].labels == "cc-by,gpl,gpl-3.0,mit" and got[999].score == 1.0


# --- 3: personal data -----------------------------------------------------
def brute_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_against_plain_expressions():
    rng = random.Random(2)
    for _ in range(30_000):
        t = "".join(rng.choice("ab.1290@@+- ()_%\n.é٣") for _ in range(rng.randint(0, 30)))
        assert pii_bootstrap.base_spans(t) == brute_spans(t), t
    parts = ["4111 1111 1111 1111", "4111111111111111", "10.0.0.1", "1.2.3.4.5", "+1 (499) 555-6503", "00000255.1.1.1", " ", "x", "-", ".", "4", "@a.b", "a.b@c-d.e.f"]
    for _ in range(5_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        assert pii_bootstrap.base_spans(t) == brute_spans(t), t


def test_bootstrap_finds_unseen_identifiers_by_context(spark):
    docs = [(i, f"please write to support mail: user{i}@mail.com now") for i in range(8)]
    docs += [(100 + i, f"please write to support mail: user{i}_77 now") for i in range(3)]
    docs += [(200 + i, f"it was made in the year 20{10 + i} by hand, and in the year before") for i in range(9)]
    docs += [(300 + i, f"call the desk {i}0.0.0.1 or the desk of another floor, the desk is open") for i in range(4)]
    docs += [(400, "the desk ab1234")]  # followed by words as often as by identifiers
    got = {r.doc_id: r for r in pii_bootstrap.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[100 + i].spans == "id:30:38" and got[100 + i].n_email == 0 for i in range(3))
    assert all(not got[200 + i].spans for i in range(9)) and not got[400].spans
    for d, text in docs:
        base = ",".join(f"{pii_bootstrap.KINDS[k]}:{a}:{b}" for a, k, b in brute_spans(text))
        assert got[d].base_sha256 == hashlib.sha256(base.encode()).hexdigest()


def test_totals_cover_every_identifier_in_its_pattern(texts):
    odd = ["pay by card #99887766 and card #-7712, card \u201c4012888888881881\u201d", "\u8acb\u806f\u7d61 \u90f5\u7bb1a1@b.com foo acct4012888888881881 or tel+15551234567", "see " + "w" * 90 + " ref 88120 (id:\"77120\") \u0130d \u0391\u03a3\u0391\u03a3 \u03a34411"]
    for text in [*odd, *list(texts.values())[:150]]:
        base = pii_bootstrap.base_spans(text)
        starts = sorted({a for a, *_ in base} | {a for a, _ in pii_bootstrap.other_identifiers(text, base)})
        want = Counter(p for p in (pii_bootstrap.pattern_before(text, a) for a in starts) if p)
        got = Counter(pii_bootstrap.patterns_before(text, starts))
        assert all(got[p] >= n for p, n in want.items()), want - got
    places = pii_bootstrap.patterns_before("my card #one my card #two", [])
    assert places.count("card #") == 2 and places.count("my card") == 2 and places.count("card #one") == 1


def test_identifiers_that_touch_their_pattern_are_found(spark):
    cards = ["4012888888881881", "4111111111111111", "5555555555554444", "378282246310005"]
    docs = [(i, f"please use my card #{c} and \u8acb\u806f\u7d61 \u90f5\u7bb1a{i}@b.com or go to \u201cx{i}@b.com\u201d now") for i, c in enumerate(cards)]
    docs += [(10, "please use my card #99887766 now"), (11, "\u8acb\u806f\u7d61 \u90f5\u7bb1zz9911 now"), (12, "or go to \u201cqq7788\u201d now")]
    docs += [(20 + i, f"play the game #{c} now") for i, c in enumerate(cards)] + [(30 + i, "the game #winning team") for i in range(30)] + [(70, "the game #99887766 now")]
    got = {r.doc_id: r for r in pii_bootstrap.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = {d: [docs_text[int(a) : int(b)] for k, a, b in (x.split(":") for x in got[d].spans.split(",") if x) if k == "id"] for d, docs_text in docs}
    assert (found[10], found[11], found[12], found[70]) == (["99887766"], ["zz9911"], ["qq7788"], [])


# --- 4: token files -------------------------------------------------------
def test_chunk_encoder_against_library():
    tok, enc = library(), word_tokens.ChunkEncoder(TOKENIZER, cache_entries=500)
    for t in odd_texts(8000, 1):
        assert array("I", tok.encode(t, add_special_tokens=False).ids).tobytes() == enc.encode(t), repr(t)


def test_token_files_round_trip(spark, texts):
    tok, path = library(), scratch_path(spark, "round-trip")
    token_files.write_token_files(documents(spark, SF), path, TOKENIZER, pack_bytes=4096)
    got = token_files.read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(texts)
    start = 0
    for r in got:
        ids = array("I", [*tok.encode(texts[r.doc_id], add_special_tokens=False).ids, 1])
        assert (r.start, r.n_tokens, bytes(r.ids), r.ids_crc32) == (start, len(ids), ids.tobytes(), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_files.fetch_document(spark, path, 7) == [array("I", [*tok.encode(texts[7], add_special_tokens=False).ids, 1])]
    packs = spark.read.parquet(f"{path}/packs")
    assert packs.count() > 3 and len(token_files.read_dictionary(spark, path)) > 0
    with pytest.raises(ValueError):
        list(token_files.unpack(bytes(packs.first()["pack"]), b"another"))


# --- 5: near duplicates ---------------------------------------------------
def plain_fingerprint(t):
    w = [x.encode() for x in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))]
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def least_reachable(fps: dict):
    owner = {f: f for f in set(fps.values())}

    def root(f):
        while owner[f] != f:
            f = owner[f]
        return f

    distinct = sorted(owner)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 3:
                owner[root(a)] = root(b)
    least = {}
    for d, f in sorted(fps.items()):
        least.setdefault(root(f), d)
    return {d: least[root(f)] for d, f in fps.items()}


def test_simhash_against_all_pairs(spark, texts):
    docs = [(d, t) for d, t in texts.items()] + [(9000, ""), (9001, None), (9002, " one two "), (9003, "ONE two")]
    fps = {d: plain_fingerprint(t or "") for d, t in docs}
    got = simhash_anchor.simhash_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.fp % (1 << 64) for r in got} == fps
    assert {r.doc_id: r.component_id for r in got} == least_reachable(fps)


def test_anchor_links_lose_no_pair(spark):
    rng = random.Random(11)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):  # chains of neighbours, up to four bits apart
        for _ in range(6):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            fps.add(f)
    fps |= {0, 1, 7, 15, (1 << 64) - 1, (1 << 64) - 8, 1 << 63, 3 << 61}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    want = {(a, b) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 3}
    got = simhash_anchor.linked_fingerprints(spark.createDataFrame(signed, "fp long"))
    assert {(r.a, r.b) for r in got.collect()} == want and len(want) > 50


# --- 6 and 8: models on held-out rows -------------------------------------
def test_models_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.lang for r in documents(spark, sf).collect()}
    got = [r for r in QUERIES["op6_language_id"](spark, sf).collect() if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == docs[r.doc_id] for r in got) > 0.97 * len(got) > 0
    quality = {r.doc_id: r.quality for r in documents(spark, sf, "labels").collect()}
    got = [r for r in QUERIES["op8_quality_classifier"](spark, sf).collect() if r.held_out and r.doc_id in quality]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in got)
    assert sum(r.predicted == quality[r.doc_id] for r in got) > 0.95 * len(got) > 0


# --- 7: quality rules -----------------------------------------------------
def spark_hash(*words):
    h = 42
    for w in words:
        h = xxh64_intdigest(w.encode(), h)
    return (h - (1 << 64) if h >> 63 else h) % quality_llr.BUCKETS


def test_quality_rules_against_plain_counts(spark, texts):
    docs = [*texts.items(), (9000, "a b c a b c a b\n x\n\n x\nx\n"), (9001, "z " * 60), (9002, "a b a b a b c\x1cd e")]
    good = {d for d in texts if d % 3 == 0}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in quality_llr.quality_rules(frame, spark.createDataFrame([(d,) for d in good], "doc_id long")).collect()}
    raw, trusted, grams = Counter(), Counter(), {}
    for d, t in docs:
        w = WORD.findall(t)
        grams[d] = [spark_hash(x) for x in w] + [spark_hash(a, b) for a, b in zip(w, w[1:])]
        raw.update(grams[d])
        if d in good:
            trusted.update(grams[d])
    n_raw, n_good = sum(raw.values()) + quality_llr.BUCKETS, sum(trusted.values()) + quality_llr.BUCKETS
    for d, t in docs:
        w, r = WORD.findall(t), got[d]
        seen = Counter(zip(w, w[1:], w[2:]))
        repeats = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if seen[x] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeats))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (len(w) < 50 or 100 * len(repeats) > 50 * len(w))
        ratios = [math.log((trusted[g] + 1) / n_good) - math.log((raw[g] + 1) / n_raw) for g in grams[d]]
        want = sum(ratios) / len(ratios) if ratios else 0.0
        assert abs(r.ratio - want) < 1e-9 and r.kept == (not r.base_failed and r.ratio >= quality_llr.THRESHOLD)


# --- 9: prefix counts -----------------------------------------------------
def test_prefix_counts_against_library(texts):
    c = prefix_counts.PrefixCounter(TOKENIZER, cache_entries=300)
    for t in odd_texts(1500, 5):
        assert [int(x) for x in array("h", c.changes(t))] == [b - a for a, b in zip([0, *c.library_counts(t)], c.library_counts(t))], repr(t)
    for t in list(texts.values())[:4]:
        c.prepare([t])
        counts, cum = array("h", c.changes(t[:400])), 0
        for i, x in enumerate(counts, 1):
            cum += x
            assert cum == len(c.tokenizer.encode(t[:i], add_special_tokens=False).ids)


def test_prefix_tables_answer_budgets(spark, texts):
    tok = library()
    rows = prefix_counts.prefix_tables(documents(spark, SF), TOKENIZER, budget=50).collect()
    for r in rows:
        t = texts[r.doc_id]
        n = len(tok.encode(t, add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes) == (n, len(t.encode()))
        table = bytes(r.prefix_table)
        assert prefix_counts.longest_within(table, 50) == r.fits_chars and len(prefix_counts.prefix_counts(table)) == len(t) + 1
        assert len(tok.encode(t[: r.fits_chars], add_special_tokens=False).ids) <= 50
        assert r.fits_chars == len(t) or len(tok.encode(t[: r.fits_chars + 1], add_special_tokens=False).ids) > 50


# --- 10: mixing -----------------------------------------------------------
def reshared_targets(sizes, share=1.5, repeats=2):
    """Targets by sharing the excess again, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= repeats * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        target |= {s: float(repeats * sizes[s]) for s in over}
        left -= sum(repeats * sizes[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_against_shared_rounds(spark, seed):
    rng = random.Random(seed)
    docs = [(i, " ".join("w" * rng.randint(0, 40)), rng.choice(["a", "é", "B", "b", None, "a", "a", "zz"])) for i in range(300)]
    docs += [(1000, " ".join("w" * 900), "small"), (1001, None, "empty"), (1002, " ".join("w" * 700), "zz")]
    got = {r.doc_id: r for r in mix_wfq.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    sizes, taken = Counter(), Counter()
    for d, t, s in docs:
        assert got[d].size == len((t or "").split()) and 0 <= got[d].taken <= 2 * got[d].size
        sizes[s] += got[d].size
        taken[s] += got[d].taken
    target = reshared_targets(sizes)
    for d, _, s in docs:
        assert got[d].source_size == sizes[s] and math.isclose(got[d].target, target[s], abs_tol=1e-6)
    assert sum(taken.values()) == int(1.5 * sum(sizes.values()) + 1e-9)
    assert all(abs(taken[s] - target[s]) <= len(sizes) for s in sizes)


def test_mix_reruns_agree(spark):
    docs = documents(spark, SF)
    once = {r.doc_id: r.taken for r in mix_wfq.mix(docs).collect()}
    assert once == {r.doc_id: r.taken for r in mix_wfq.mix(docs.repartition(5)).collect()}


# --- the pipeline ---------------------------------------------------------
def test_pipeline_stages(spark, texts):
    import corpus_pipeline

    from tablewright.llm.common import written

    docs, rows = documents(spark, SF), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, SF), name)
        rows[name] = docs.collect()
        if name != "token_binary":
            assert docs.columns == before.columns
    # the classifier keeps what is labelled good
    kept = {r.doc_id for r in rows["quality_classifier"]}
    quality = {r.doc_id: r.quality for r in documents(spark, SF, "labels").collect()}
    assert sum(q == (d in kept) for d, q in quality.items()) > 0.95 * len(quality)
    # one document of each near-duplicate group stays
    least = least_reachable({r.doc_id: plain_fingerprint(r.text) for r in rows["quality_classifier"]})
    assert sorted(r.doc_id for r in rows["near_dedup"]) == sorted(set(least.values()))
    # no planted item is left, nothing else went
    flat = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [flat(r.text) for r in documents(spark, SF, "benchmark").collect()]
    leaks = {r.doc_id for r in rows["near_dedup"] if any(x in flat(r.text) for x in items)}
    assert leaks and {r.doc_id for r in rows["near_dedup"]} - {r.doc_id for r in rows["decontamination"]} == leaks
    # the mix takes what the mixing operator says
    mixed = Counter()
    for r in rows["source_mixing"]:
        mixed[r.doc_id] += len(WORD.findall(r.text))
    clean = spark.createDataFrame(rows["decontamination"])
    assert mixed == Counter({r.doc_id: r.taken for r in mix_wfq.mix(clean).collect() if r.taken})
    # and the files hold the tokens of exactly these rows
    tok = library()
    want = Counter((r.doc_id, len(tok.encode(r.text, add_special_tokens=False).ids) + 1) for r in rows["source_mixing"])
    assert Counter((r.doc_id, r.n_tokens) for r in rows["token_binary"]) == want
