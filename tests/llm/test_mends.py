"""Short documents and null items, long windows, numerals without letters."""

import numpy as np
import pytest

from quarry.llm import debruijn, decontam, ppm_langid, secrets, suffix_dedup
from tests.llm.test_llm import brute_bytes, brute_words


def test_documents_shorter_than_the_item_and_null_items(spark):
    item = " ".join(f"w{i}" for i in range(50))
    words = item.split()
    texts = [" ".join(words[:48]), " ".join(words[:48]) + " a b c", " ".join(words[:30]), " ".join(words[:4]), " ".join(words[2:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (None, item), (8, None)], "item_id long, text string")
    for block in (1, 10):
        got = {r["doc_id"]: r for r in decontam.decontaminate(docs, bench, items_per_block=block).collect()}
        assert [sorted(got[k]["items"], key=str) for k in range(5)] == [[7, None], [7, None], [], [], [7, None]]
        assert "null:0:48" in got[0]["spans"] and got[0]["n_items"] == 2 and got[0]["max_similarity"] == pytest.approx(44 / 46)


@pytest.mark.parametrize("window", [8, 20, 400])
def test_long_windows(spark, window):
    rng = np.random.default_rng(3)
    word = [f"w{i}" for i in range(3000)]
    base = list(rng.choice(word, 900))
    texts = {1: " ".join(base[:700]), 2: " ".join(base[:700]), 3: " ".join(base[100:]), 4: " ".join(base[:300] + list(rng.choice(word, 300))), 5: " ".join(["a"] * 1000)}
    df = spark.createDataFrame(sorted(texts.items()), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in debruijn.remove_repeats(df, window=window).collect()}
    assert got == brute_words(texts, window)


def test_neighbours_across_partitions(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ROWS_PER_TASK", 16)
    rng = np.random.default_rng(5)
    parts = [" ".join(rng.choice(list("abcde"), 60)) for _ in range(8)]
    texts = {i: " ".join([parts[k] for k in rng.integers(0, 8, 3)] + list(rng.choice(list("abcdefgh"), rng.integers(0, 30)))) for i in range(80)}
    df = spark.createDataFrame(sorted(texts.items()), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(df, length=40).collect()}
    assert got == brute_bytes(texts, 40)


def test_numerals_are_no_letters(spark):
    rows = [(i, "the cat sat on the mat", "en") for i in range(5)] + [(10, "½ ² ③ 12", "en"), (11, "½ a", "en"), (12, "日", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in ppm_langid.predict(docs, docs["doc_id"] < 5).collect()}
    assert got[10] == "und" and got[11] == got[12] == "en"


def test_references_and_types_are_no_secrets():
    cost = secrets.GuessCost()
    for text in ("def get(key: Optional[Mapping[str, Any]])", "primary key: customer_identifier", "password: ${DB_PASSWORD_PLACEHOLDER}",
                 "token = os.environ['X']", 'secret: "{{ vault.secret_value }}"', "password=<YOUR-PASSWORD-HERE>", "api_key = $MY_SECRET_API_KEY", "pwd = %(db_password)s"):
        assert secrets.guess_spans(text, cost, 9.0) == [], text
    for text in ("password: Zk8#qT!9vLx2", 'key = "wJalrXUtnFEMI/K7MDENG"', "token: x_9fK2_qq7Zt", "secret=a9[Kq(2z!Wm"):
        assert len(secrets.guess_spans(text, cost, 9.0)) == 1, text
