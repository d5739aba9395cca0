"""Results that SQL cannot express, against plain computations that share no code with the operators."""

import hashlib
import math
import re
import struct
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexspark.llm import common, jaccard_join, language_id, language_model, media, mixing, quality_rules, queries, secret_scan, token_binary

DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality rules: votes, expectation-maximisation and verdicts


def votes_of(text, function_words):
    words, text = WORD.findall(text), text
    n, chars = len(words), sum(map(len, words))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(n - 4)]
    times = Counter(grams)
    repeats = len({j for i, g in enumerate(grams) if times[g] > 1 for j in range(i, i + 5)})
    symbols, marks = len(re.findall(r"[#*$%&|<>]", text)), len(re.findall(r"[#*$%&|<>]+", text))
    upper, exclaim, digits = len(re.findall("[A-ZÀ-ÖØ-Þ]", text)), text.count("!"), len(re.findall("[0-9]", text))
    doubled, distinct, known = len(lines) - len(set(lines)), len(set(words)), len(set(words) & function_words)
    bad_good = [
        (symbols > 0.15 * n, symbols <= 0.05 * n), (marks > 0.1 * n, marks <= 0.03 * n), (doubled > 0.3 * len(lines), doubled <= 0.1 * len(lines)),
        (repeats > 0.12 * n, repeats <= 0.03 * n), (upper > 0.4 * chars, upper <= 0.2 * chars), (exclaim > 0.2 * n, exclaim <= 0.05 * n),
        (chars < 2 * n or chars > 15 * n, 3 * n <= chars <= 10 * n), (distinct <= 0.5 * n and n <= 60, distinct > 0.6 * n),
        (digits > 0.3 * chars, digits <= 0.1 * chars), (n >= 40 and known == 0, known >= 2),
    ]
    return n < 10 or 100 * repeats > 20 * n, tuple("bad" if b else "good" if g else None for b, g in bad_good)


def likelihood(vote, on):
    return math.prod({"bad": p, "good": 1 - p, None: 1}[v] for v, p in zip(vote, on))


def test_quality_verdicts_follow_plain_em(docs):
    df, rows = docs
    judged = {d: votes_of(t or "", set(quality_rules.FUNCTION_WORDS)) for d, t, *_ in rows}
    open_ = [v for failed, v in judged.values() if not failed]
    share, bad, good = 0.15, [0.2] * 10, [0.002] * 10
    k = max(2, 0.05 * len(open_))
    for _ in range(300):
        p = [share * likelihood(v, bad) / (share * likelihood(v, bad) + (1 - share) * likelihood(v, good)) for v in open_]
        share = (sum(p) + 0.15 * k) / (len(p) + k)
        rate = lambda r, w, prior, start: (sum(x for x, v in zip(w, open_) if v[r] == "bad") + prior * start) / (sum(x for x, v in zip(w, open_) if v[r]) + prior)
        bad, good = [rate(r, p, 0.15 * k, 0.2) for r in range(10)], [rate(r, [1 - x for x in p], 0.85 * k, 0.002) for r in range(10)]
    found = {r["doc_id"]: r for r in quality_rules.judge(df).collect()}
    for d, (failed, v) in judged.items():
        odds = (1 - share) * likelihood(v, good) / (share * likelihood(v, bad))
        assert abs(found[d]["p_good"] - odds / (1 + odds)) < 1e-5
        assert found[d]["base_failed"] == failed and found[d]["kept"] == (not failed and odds >= 1)
    assert {found[d]["kept"] for d in judged} == {True, False}


# --- language model: deleted interpolation from counts alone


def lower(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


def plain_scores(texts):
    """score by id; texts: id to text. Exact counts, and plain EM by powers of two of the context's count."""
    tokens = {d: ["<s>", *WORD.findall(lower(t)), "</s>"] for d, t in texts.items()}
    fold = {d: zlib.crc32(str(d).encode()) % 7 for d in texts}

    def count(folds):
        words, pairs, contexts = Counter(), Counter(), Counter()
        for d, t in tokens.items():
            if fold[d] in folds:
                words.update(t[1:])
                pairs.update(zip(t, t[1:]))
                contexts.update(t[:-1])
        contexts["<s>"] = words["</s>"]
        return words, pairs, contexts

    words, pairs, contexts = count({0, 1, 3, 4, 5, 6})
    kept_words, kept_pairs, kept_contexts = count({0, 1, 4, 5, 6})
    n, v, n_kept = sum(words.values()), len(words), sum(kept_words.values())
    bucket = lambda c: c.bit_length()
    held = defaultdict(Counter)
    for d, t in tokens.items():
        if fold[d] == 3:
            for u, w in zip(t, t[1:]):
                c = kept_contexts[u]
                held[bucket(c)][kept_pairs[u, w] / max(c, 1), kept_words[w] / n_kept, 1 / (v + 1)] += 1
    weights, last = {}, [0.3, 0.6, 0.1]
    for b in range(64):
        if held[b]:
            last = [0.3, 0.6, 0.1]
            for _ in range(language_model.EM_ROUNDS):
                sums = [0.01] * 3
                for shares, m in held[b].items():
                    parts = [x * y for x, y in zip(last, shares)]
                    for i in range(3):
                        sums[i] += m * parts[i] / sum(parts)
                last = [x / sum(sums) for x in sums]
        weights[b] = last if b else [0.0, last[1] / (last[1] + last[2]), last[2] / (last[1] + last[2])]
    out = {}
    for d, t in tokens.items():
        out[d] = 0.0
        for u, w in zip(t, t[1:]):
            c = words["</s>"] if u == "<s>" else words[u]
            x, y, z = weights[bucket(c)]
            out[d] += math.log10(x * pairs[u, w] / max(c, 1) + y * words[w] / n + z / (v + 1))
    return out


def test_language_model_scores(docs):
    df, rows = docs
    wanted = plain_scores({d: t for d, t, *_ in rows})
    found = {r["doc_id"]: r for r in language_model.score(df).collect()}
    for d, score in wanted.items():
        assert abs(found[d]["score"] - score) < 1e-4 * max(1, -score)
        assert abs(found[d]["token_score"] * found[d]["n_tokens"] - found[d]["score"]) < 1e-9 * -found[d]["score"]


def test_weights_are_those_of_a_mixture(spark):
    cells = spark.createDataFrame([(0, 0, 0, 7, 5), (3, 2, 5, 4, 9), (3, 0, 0, 1, 4)], "bucket int, bigram long, context long, word long, tokens long")
    lam = language_model.fit_weights(cells, 100, 50)
    assert np.allclose(lam.sum(1), 1) and (lam >= 0).all() and lam[0][0] == 0 and np.allclose(lam[4], lam[3]) and np.allclose(lam[2], lam[1])


@pytest.mark.parametrize("module", ["language_model", "jaccard_join"])
def test_blocks_follow_the_input_not_the_partitions(spark, docs, monkeypatch, module):
    """With four times the partitions units grow, and no more blocks are sent."""
    df, small = docs[0].select("doc_id", "text").coalesce(1), 1 << 14
    monkeypatch.setattr(common, "BLOCK_BYTES", 1 << 11)
    sent = []
    for n in (8, 32):
        if module == "language_model":
            monkeypatch.setattr(language_model, "UNIT_BYTES", small)
            folder = common.new_folder(spark, "blocks")
            rows = language_model._send_words(df, folder, n).where(f"kind = {language_model.BLOCK}")
        else:
            monkeypatch.setattr(jaccard_join, "input_partitions", lambda _: n)
            monkeypatch.setattr(jaccard_join, "unit_bytes", lambda parts: max(small, parts * common.BLOCK_BYTES))
            rows = jaccard_join._sets_and_shares(df, 4).where(f"kind = {jaccard_join.COUNTS} AND part = 0")
        sent.append(rows.count())
    assert sent[0] > 8 and sent[1] <= 1.2 * sent[0]


@pytest.mark.parametrize("terabytes", [0.0001, 0.01, 1, 100])
def test_partitions_and_units_bound_the_number_of_blocks(spark, monkeypatch, terabytes):
    known = int(terabytes * 1e12)
    class Sized:
        sparkSession = spark

        def __getattr__(self, name):
            return lambda *_: 1 if name == "size" else str(known) if name == "sizeInBytes" else self

        _jdf = property(lambda self: self)

    n = common.input_partitions(Sized())
    unit = common.unit_bytes(n)
    assert (known / unit) * n * common.BLOCK_BYTES <= 1.01 * known and unit < 1 << 30 and known / n < 1 << 30


def test_a_cluster_must_name_the_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())


# --- media: an own decoder, transform and digests


def decoded(png):
    assert png[:8] == b"\x89PNG\r\n\x1a\n"
    at, data, width, height = 8, b"", 0, 0
    while at < len(png):
        size, kind = struct.unpack(">I4s", png[at : at + 8])
        body = png[at + 8 : at + 8 + size]
        assert struct.unpack(">I", png[at + 8 + size : at + 12 + size])[0] == zlib.crc32(kind + body)
        if kind == b"IHDR":
            width, height = struct.unpack(">II", body[:8])
            assert body[8:] == bytes([8, 0, 0, 0, 0])
        data += body if kind == b"IDAT" else b""
        at += 12 + size
    data, above, out = zlib.decompress(data), [0] * width, []
    for y in range(height):
        kind, *line = data[y * (width + 1) : (y + 1) * (width + 1)]
        for x in range(width):
            a, b, c = line[x - 1] if x else 0, above[x], above[x - 1] if x else 0
            p = a + b - c
            line[x] = (line[x] + [0, a, b, (a + b) // 2, sorted((a, b, c), key=lambda v: abs(p - v))[0]][kind]) % 256
        out.append(line)
        above = line
    return out


def plain_hash(samples):
    height, width = len(samples), len(samples[0])
    cut = lambda i, n: (i * n // 32, max(i * n // 32 + 1, (i + 1) * n // 32))
    small = [[0.0] * 32 for _ in range(32)]
    for i in range(32):
        for j in range(32):
            (a, b), (c, d) = cut(i, height), cut(j, width)
            cells = [samples[y][x] for y in range(a, b) for x in range(c, d)]
            small[i][j] = sum(cells) / len(cells)
    low = [round(sum(small[y][x] * math.cos(math.pi * u * (2 * y + 1) / 64) * math.cos(math.pi * v * (2 * x + 1) / 64) for y in range(32) for x in range(32)), 6) for u in range(8) for v in range(8)]
    middle = float(np.median(low[1:]))
    bits = "".join("1" if x > middle else "0" for x in low)
    return f"{int(bits, 2):016x}"


def test_media_features(docs, odd, spark):
    rng = np.random.default_rng(5)
    smooth = np.clip(np.add.outer(np.arange(40) * 3, np.arange(64) * 2) + rng.integers(0, 3, (40, 64)), 0, 255).astype(np.uint8)
    png = media.write_png(smooth)
    assert decoded(png) == smooth.tolist() and len({line[0] for line in media.filtered_lines(png)}) > 1
    for image in (smooth, smooth[:1], rng.integers(0, 256, (7, 64), dtype=np.uint8), np.zeros((3, 5), np.uint8)):
        assert media.cosine_hash(image).hex() == plain_hash(image.tolist())
    for df, most in ((docs[0].select("doc_id", "text").limit(25), 30), (odd, 2_000)):
        coded = media.encode_media(df, "text")
        assert "text" not in coded.columns
        by_payload = {}
        for r in coded.collect():
            samples = decoded(bytes(r["media"])) if len(r["media"]) < 60_000 else media.read_png(bytes(r["media"])).tolist()
            payload = bytes(x for line in samples for x in line)
            by_payload[hashlib.sha256(payload).hexdigest()] = (len(payload), zlib.crc32(payload[-64:]), len(r["media"]), hashlib.sha256(bytes(r["media"])).hexdigest(), plain_hash(samples))
        texts = [(r["text"] or "").encode() for r in df.select("text").collect()]
        padded = Counter(hashlib.sha256(t + bytes(-len(t) % 64 if t else 64)).hexdigest() for t in texts)
        found = media.media_features(coded).collect()
        assert Counter(r["payload_sha256"] for r in found) == padded
        for r in found:
            assert by_payload[r["payload_sha256"]] == (r["payload_bytes"], r["tail_crc32"], r["media_bytes"], r["media_sha256"], r["feature"])
    clashing = media.media_features(media.encode_media(odd)).select("words", "ids", "unit", "source")
    assert Counter(map(tuple, clashing.collect())) == Counter((r["words"], r["ids"], r["unit"], r["source"]) for r in odd.collect())
    assert media.media_features(spark.createDataFrame([(1, None)], "doc_id long, media binary")).first()["feature"] is None


# --- language identification: the same backoff with strings


def plain_words(text):
    folded = "".join(c.lower() if c.isascii() and c.isalpha() else c if ord(c) > 127 else " " for c in text)
    return folded.split(" ")


def plain_grams(word):
    framed = f" {word} "
    return {n: [g for i in range(len(framed) - n + 1) if (g := framed[i : i + n]) != " " * n] for n in range(1, 6)}


def test_language_scores(docs):
    df, rows = docs
    languages = sorted({lang for _, _, lang, _ in rows if lang})
    tables = {n: defaultdict(lambda: [0.5] * len(languages)) for n in range(6)}
    for d, text, lang, _ in rows:
        if text is not None and lang is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            for word in filter(None, plain_words(text)):
                tables[0][word][languages.index(lang)] += 1
                for n, grams in plain_grams(word).items():
                    for g in grams:
                        tables[n][g][languages.index(lang)] += 1
    totals = {n: [sum(v[j] for v in t.values()) for j in range(len(languages))] for n, t in tables.items()}
    log = lambda n, key: [math.log(tables[n][key][j] / totals[n][j]) for j in range(len(languages))]
    found = {r["doc_id"]: r for r in language_id.predict(df, language_id.fit(language_id.training_rows(df), sample_rows=10**9)).collect()}
    for d, text, _, _ in rows:
        score, unseen = [0.0] * len(languages), 0
        for word in filter(None, plain_words(text or "")):
            if word in tables[0]:
                own = log(0, word)
            else:
                unseen += 1
                own = [0.0] * len(languages)
                for n in range(5, 0, -1):
                    if known := [g for g in plain_grams(word)[n] if g in tables[n]]:
                        own = [sum(log(n, g)[j] for g in known) / len(known) for j in range(len(languages))]
                        break
            score = [a + b for a, b in zip(score, own)]
        letters = any(unicodedata.category(c)[0] == "L" for c in text or "")
        share = [math.exp(x - max(score)) for x in score]
        r = found[d]
        assert r["lang_pred"] == (languages[score.index(max(score))] if letters else "und") and r["n_unseen"] == unseen
        assert abs(r["score"] - (max(share) / sum(share) if letters else 0)) < 1e-3


# --- the others


def test_later_orders_remove_candidates():
    """Sets that share a few shingles of one half are candidates by the first order, and not by the others."""
    rng = np.random.default_rng(1)
    own = [np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64)) for _ in range(2)]
    half = (common.mixed(own[0] + np.uint64(0xE7037ED1A0B428DB)) & np.uint64(1)).astype(bool)
    for side in (False, True):
        sets = [np.sort(own[0]), np.sort(np.concatenate([own[0][half == side][:20], own[1]]))]
        cuts = np.cumsum([0, *map(len, sets)])
        flat = np.concatenate(sets)
        _, inverse, times = np.unique(flat, return_inverse=True, return_counts=True)
        df = np.where(times[inverse] > 1, 2, 30)  # what both have is rare
        meets = []
        for tokens, of in jaccard_join.prefixes(flat, cuts, df, 85):
            a, b = (set(tokens[of == i].tolist()) for i in range(2))
            meets.append(bool(a & b))
        assert meets[0] and not all(meets[1:])
    alike = [np.sort(own[0]), np.sort(own[0][:-5])]
    flat, cuts = np.concatenate(alike), np.cumsum([0, *map(len, alike)])
    for tokens, of in jaccard_join.prefixes(flat, cuts, np.full(len(flat), 2), 85):
        assert set(tokens[of == 0].tolist()) & set(tokens[of == 1].tolist())


def test_grid_of_a_large_group(spark):
    """Members linked in chains, not with their pivot: tries in cells of any size find all links."""
    sets = {i: np.array([10_000, *range(i * 3, i * 3 + 60)], np.uint64) for i in range(40)}
    rows = [(i, len(s), bytearray(jaccard_join.pack(s, np.array([10_000], np.uint64), np.array([10_000], np.uint64)))) for i, s in sets.items()]
    frame = spark.createDataFrame(rows, "node long, n long, payload binary")
    tried = spark.createDataFrame([(0, i, False) for i in range(1, 40)], "pivot long, node long, linked boolean")
    none = spark.createDataFrame([], "node long, label long")
    for side in (3, 512):
        links = jaccard_join._tried_within_groups(tried, none, frame, 85, side)
        labels = {r["label"] for r in jaccard_join.components(links.unionByName(spark.createDataFrame([(1, 1)], "a long, b long"))).collect()}
        assert labels == {1}


def test_postings_as_rows_give_the_same_candidates(docs, odd):
    queries_ = [(i, q) for i, r in enumerate(secret_scan.RULES) for q in secret_scan.trigram_query(r.pattern) or []]
    trigrams = sorted({g for _, q in queries_ for g in q})
    for df in (docs[0], odd):
        stored = secret_scan.candidates(secret_scan.postings(df, trigrams), queries_, trigrams)
        beside = df.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("whole")).withColumn("own", secret_scan.own_postings("whole", trigrams))
        beside = beside.withColumn("rules", secret_scan.met_rules("own", queries_, trigrams)).where("size(rules) > 0").select("doc_id", "text_hash", "rules").distinct()
        key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text_hash"], sorted(r["rules"]))
        assert sorted(map(key, stored.collect())) == sorted(map(key, beside.collect()))
        assert df is not odd or stored.where("doc_id = 7").first()["rules"]


def test_scan_moves_no_rows(odd):
    plan = secret_scan.scan(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_token_shards_of_odd_rows(odd, spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    crc = lambda t: (lambda ids: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
    for df in (odd, odd.repartition(5)):
        found = token_binary.read_ids(token_binary.write_ids(df, public_tokenizers.path("byte_bpe_50k.json"), shard_ids=300)).collect()
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == Counter((r["doc_id"], *crc(r["text"])) for r in odd.collect())
        placed = sorted(found, key=lambda r: r["start"])
        assert [r["doc_id"] for r in placed if r["doc_id"] is not None] == sorted(r["doc_id"] for r in found if r["doc_id"] is not None)
        assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(placed, placed[1:]))


def test_mixed_documents_are_whole_copies(docs, odd):
    for df in (docs[0], odd):
        wanted = Counter()
        for r in mixing.mix(df).collect():
            wanted[r["doc_id"], r["source"]] += 1 if r["size"] == 0 else math.floor(r["taken"] / r["size"] + 0.5)
        again = mixing.mixed_documents(df)
        texts = {(r["doc_id"], r["source"]): r["text"] for r in df.collect()}
        found = again.collect()
        assert Counter((r["doc_id"], r["source"]) for r in found) == +wanted and all(texts[r["doc_id"], r["source"]] == r["text"] for r in found)


def test_queries_name_the_ten():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
