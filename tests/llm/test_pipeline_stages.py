"""The filtering stages of the pipeline on planted and odd rows, against brute-force versions."""

import base64
import random
import zlib

import pytest
import xxhash

import corpus_pipeline
from quarry.llm import decontam, ppm_langid, secrets

SF_SMALL = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_language_stage_rejects_what_no_language_predicts(spark, docs):
    rng = random.Random(4)
    junk = [base64.b64encode(rng.randbytes(n)).decode() for n in (900, 3000, 30_000)] + ["", None, "12 ½ !!", "".join(map(chr, rng.choices(range(0x4E00, 0x9000), k=800)))]
    rows = [(10**6 + k, t, None, "s", len(t or "")) for k, t in enumerate(junk)]
    given = docs.select("doc_id", "text", "lang", "source", "n_chars")
    short = [(2 * 10**6 + k, " ".join(r["text"].split()[:12]), r["lang"], "s", 1) for k, r in enumerate(given.where("length(text) > 200").limit(40).collect())]
    out = STAGE["language_id"](spark, given.unionByName(spark.createDataFrame(rows + short, given.schema)), SF_SMALL)
    kept = {r["doc_id"] for r in out.collect()}
    clean = {r["doc_id"] for r in given.where("text rlike '[a-z]'").collect()} | {i for i, *_ in short}
    assert out.columns == given.columns
    assert not kept & {i for i, *_ in rows} and len(clean - kept) <= 0.01 * len(clean)


def brute_language(rows):
    """The stage without Spark, on tables within the bounds of the sample."""
    train = [(t, g) for i, t, g in rows if i is None or zlib.crc32(str(i).encode()) % 4 != 2]
    learned = {}
    for t, g in train:
        if t is not None and g is not None:
            learned.setdefault(g, []).append(t.encode())
    model = ppm_langid.fit(learned)

    def judge(text):
        if not text or not any(map(str.isalpha, text)):
            return None
        bits = ppm_langid.code_lengths(model, [text.encode()])[0]
        k = int(bits.argmin())
        return model.langs[k], 1 / sum(2.0 ** max(bits[k] - b, -1000) for b in bits), bits[k] / len(text.encode())
    rates = {}
    for t, g in train:
        found = judge(t)
        if found and found[0] == g:
            rates.setdefault(g, []).append((found[2], len(t.encode())))
    out = []
    for i, t, _ in rows:
        found = judge(t)
        if not found or found[1] < corpus_pipeline.MIN_LANGUAGE_SCORE:
            continue
        own = [r for r, _ in rates.get(found[0], ())]
        if own:
            mean, size = sum(own) / len(own), sum(n for _, n in rates[found[0]]) / len(own)
            spread = (sum((r - mean) ** 2 for r in own) / len(own)) ** 0.5
            room = max(corpus_pipeline.MAX_DEVIATIONS * spread, corpus_pipeline.MIN_EXCESS * mean)
            if found[2] > mean + room * max(1.0, (size / len(t.encode())) ** 0.5):
                continue
        out.append((i, t))
    return sorted(out, key=str)


def test_language_stage_against_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    rows += [(None, rows[0][1], None), (None, None, "en"), (7_000_000, "zq" * 400, None), (7_000_000, "zq" * 400, None)]
    out = STAGE["language_id"](spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), SF_SMALL)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == brute_language(rows)


def fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[k:k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicate_stage_against_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(8_000_000 + k, rows[3][1] + " x" * (k % 2)) for k in range(6)] + [(None, rows[3][1]), (9_000_000, ""), (9_000_001, None)]
    prints = {i: fingerprint(t) for i, t in rows if i is not None}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if root[b] < root[a] and (prints[a] ^ prints[b]).bit_count() <= 2:
                    root[a], changed = root[b], True
    out = STAGE["simhash_near_dedup"](spark, spark.createDataFrame(rows, "doc_id bigint, text string"), SF_SMALL)
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == sorted([i for i in root if root[i] == i] + [None], key=str)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_tables(spark, docs, name):
    """Null ids, clashing extra columns, a table without rows."""
    given = docs.limit(60)
    extra = {c: given["doc_id"].cast("string") for c in ("_row", "_id", "_text", "spans", "score", "component_id", "items", "h", "_size", "value", "_rid")}
    odd = given.withColumns(extra)
    nulls = spark.createDataFrame([tuple(None for _ in odd.columns)] * 2, odd.schema)
    for table, least in ((odd.unionByName(nulls), 1), (odd.where("doc_id < 0"), 0)):
        out = STAGE[name](spark, table, SF_SMALL)
        assert name == "sentencepiece" or out.columns == odd.columns
        rows = out.collect()
        assert len(rows) >= least and (least or not rows)


def test_recall_of_the_decontamination_radius(spark):
    """Windows whose similarity is just above the limit are found by their fingerprints."""
    rng = random.Random(8)
    words = [f"w{k}" for k in range(4000)]
    items, texts, wanted = [], [], set()
    for k in range(150):
        m = rng.choice((40, 60, 90))
        item = rng.choices(words, k=m)
        items.append((k, " ".join(item)))
        copy = list(item)
        copy[rng.randrange(m)] = "other"
        if m == 90 and rng.random() < 0.5:
            copy[-1] = "last"
        size = m - 4
        grams = [{tuple(x[i:i + 5]) for i in range(size)} for x in (item, copy)]
        both = len(grams[0] & grams[1])
        if both / (2 * size - both) >= 0.8:
            wanted.add(k)
        texts.append((k, " ".join(rng.choices(words, k=30) + copy + rng.choices(words, k=30))))
    assert len(wanted) > 60
    found = decontam.decontaminate(spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    got = {r["doc_id"] for r in found.where("contaminated").collect()}
    assert got >= wanted  # every one, where 0.9 is asked for
