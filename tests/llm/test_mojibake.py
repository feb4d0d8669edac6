"""Garbled text: round trips of every kind of garble, decoys, held-out recall, and edge rows."""

import random

import pytest

from longtide.llm import mojibake as M
from longtide.llm.queries import p2_found
from longtide.session import table

from ..conftest import rows


@pytest.fixture(scope="module")
def lengths(spark, sf):
    from pyspark.sql import functions as F

    d = sf.replace("sf0.001", "sf0.01")
    s = table(spark, d, "series")
    values = s.select(F.explode(F.array("title", "geography")).alias("value"))
    counted = M.counted_words(values.withColumn("by", F.lit(None).cast("string")))
    return M.train(M.model_words(counted)[0]), [r[0] for r in values.filter("value IS NOT NULL").distinct().collect()]


@pytest.mark.parametrize("text", ["Índice de precios — año 2018", "Förderung der Löhne – vorläufig", "Produção de açúcar", "Численность населения"])
@pytest.mark.parametrize("chain", [["cp1252"], ["latin-1"], ["cp1252", "cp1252"], ["cp1251"], ["mac-roman"]])
def test_round_trip(lengths, text, chain):
    bad = text
    for enc in chain:
        raw = bad.encode()
        inverse = {b: c for c, b in M._bytes_of(enc).items()}
        if any(bytes([x]) not in inverse for x in raw):
            pytest.skip("no such character")
        bad = "".join(inverse[bytes([x])] for x in raw)
    got, steps, saved = M.restore(bad, lengths[0])
    assert steps and saved > 0
    assert got == text


@pytest.mark.parametrize("text", [
    "", "plain ASCII", "Retail turnover, 2015=100 Ø 5 mm", "monthly average [Ã = revised]", "Wage bill (£/m², ±2 %)", "Job vacancies ©", "Freight tonnage: seasonally adjusted", "Café prices", "µg/m³", "Čáslav", "WAGE BILL — ALL BRANCHES", "Crédito   al sector",
    "日本語のテキスト", "नमस्ते", "emoji 😀 only"])
def test_decoys_stay(lengths, text):
    assert M.restore(text, lengths[0])[:2] == (text, [])


def test_held_out_recall_and_precision(lengths):
    model, values = lengths
    rng = random.Random(1)
    clean = [v for v in values if not v.isascii() and not M.restore(v, model)[1] and not M.broken(v)]
    hit = total = right = 0
    for v in rng.sample(clean, min(300, len(clean))):
        a, b = rng.choice([("cp1252", "utf-8"), ("latin-1", "utf-8"), ("cp437", "cp1252"), ("mac-roman", "cp1250"), ("cp1251", "utf-8"), ("cp1252", "cp1250")])
        try:
            bad = v.encode(b).decode(a)
        except UnicodeError:
            continue
        if bad != v:
            got, chain, _ = M.restore(bad, model)
            total, hit, right = total + 1, hit + bool(chain), right + (got == v)
    assert total > 60 and hit / total > 0.95 and right / total > 0.9
    assert len(clean) > 0.85 * sum(not v.isascii() for v in values)


NAMES = ["Děčín", "Čáslav", "Třebíč", "Břeclav", "Kroměříž", "Přerov", "Dvůr", "Náchod"]


@pytest.mark.parametrize("source", ["other", None, "lantern_so"])
def test_a_source_that_is_garbled_throughout(spark, sf, source):
    """Its garbles are more frequent than any clean word of its language."""
    s = table(spark, sf.replace("sf0.001", "sf0.01"), "series").select("series_id", "source_id", "title", "geography")
    bad = {n: n.encode("cp1250").decode("cp1252") for n in NAMES}
    data = [(f"p:{n}:{i}", source, f"{b} total {i}", None) for n, b in bad.items() for i in range(60)]
    got = M.garbled(s.unionByName(spark.createDataFrame(data, s.schema)), "series_id", ["title", "geography"], by="source_id").filter("series_id LIKE 'p:%'").collect()
    want = {k: f"{k.split(':')[1]} total {k.split(':')[2]}" for k, _, t, _ in data if t.split(" ")[0] not in NAMES}
    found = {r["series_id"]: r["restored"] for r in got}
    assert len(want) == 420 and set(found) <= set(want)
    assert sum(k in found for k in want) >= 0.9 * len(want) and sum(found.get(k) == t for k, t in want.items()) >= 0.9 * len(want)


@pytest.mark.parametrize("lead", ["", "A", "GD", "GDP"])
def test_unspaced_text_at_every_offset(lengths, lead):
    text = lead + "消費者物価指数季節調整値完全失業率" * 25
    bad = "".join({b: c for c, b in M._bytes_of("cp1252").items()}[bytes([x])] for x in text.encode())
    assert len(bad) > 3 * M.LONG_WORD and M.restore(bad, lengths[0])[0] == text


@pytest.mark.parametrize("text", ["Förderung der Löhne – vorläufig", "Índice de precios — año 2018", "Численность населения"])
@pytest.mark.parametrize("second", [("mac-roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252")])
def test_utf8_then_single_byte(lengths, text, second):
    """UTF-8 read as cp1252, written so and read as another single-byte encoding: no single step helps."""
    bad = "".join({b: c for c, b in M._bytes_of("cp1252").items()}[bytes([x])] for x in text.encode())
    inverse = {b: c for c, b in M._bytes_of(second[0]).items()}
    forward = M._bytes_of(second[1])
    twice = "".join(inverse.get(forward.get(c, b""), c) for c in bad)
    got, chain, _ = M.restore(twice, lengths[0])
    assert twice != bad and got == text and chain


def test_letters_of_another_script_do_not_mix_in(lengths):
    assert M.restore("Èáslav", lengths[0])[0] != "Ԡslav"


def test_no_task_sorts_all_words_of_a_language(spark, sf):
    from pyspark.sql import functions as F

    s = table(spark, sf, "series").select(F.col("source_id").alias("by"), F.col("title").alias("value"))
    p = M.frequent_words(M.counted_words(s))._jdf.queryExecution().optimizedPlan().toString()
    first, last = (i for i, line in enumerate(p.split("\n")) if "row_number()" in line and line.lstrip(" :+-").startswith("Window"))
    assert "pmod(xxhash64" in p or "_w" in p and first < last


def test_operator_edges(spark, sf):
    schema = "series_id string, title string, geography string, value string"
    data = [("a", "Wage bill â€“ total", None, "x"), ("a", "Wage bill â€“ total", None, "x"), (None, "Wage bill â€“ total", "", "x"), ("b", "lost � byte", "plain", "x"), ("c", None, None, "x"), ("d", "long " * 20000 + "Ã¼", "ok", "x")] + [(f"h{i}", f"clean – title {i % 25}", "Ort", "x") for i in range(50)]
    df = spark.createDataFrame(data, schema)
    got = M.garbled(df, "series_id", ["title", "geography"])
    assert got.columns == ["series_id", "field", "value", "restored", "chain", "saved_bits"]
    found = rows(got.select("series_id", "field").distinct())
    assert ("b", "title") in found and ("a", "title") in found and (None, "title") in found and not any(str(k).startswith("h") or k == "c" for k, _ in found)
    assert got.filter("series_id = 'b'").first()["restored"] is None
    assert M.garbled(df.limit(0), "series_id", ["title"]).count() == 0
    assert p2_found(spark, sf).columns == ["series_id", "field"]
