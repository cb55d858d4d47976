"""Problems 8, 9 and 10: packing, leakage, languages."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import skysift.llm.leakage as leakage
from skysift.llm.language import TextModel, canonical_label, corrected_languages, document_languages, fold, segment_languages, sentences
from skysift.llm.leakage import ItemIndex, Tiling, lcs, leaked_items, words
from skysift.llm.packing import BestFit, pack, token_counts, tokenizer_files


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=200), st.integers(1, 6))
def test_best_fit(sizes, most):
    fit, free, open_ = BestFit(40, most), {}, set()
    for s in sizes:
        fits = [free[n] for n in open_ if free[n] >= s]
        n = fit.put(s)
        if fits:
            assert free[n] == min(fits)  # the fullest container that still fits
        else:
            assert n not in free
            if len(open_) == most:
                open_.discard(min(open_, key=lambda x: (free[x], -x)) if False else next(x for x in open_ if free[x] == min(free[y] for y in open_) and x not in fit.left()))
            free[n] = 40
        free[n] -= s
        open_.add(n) if free[n] else open_.discard(n)
        assert fit.left() == {x: free[x] for x in open_} and fit.open <= most


def test_packing(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([3, 17, 30, 64, 99, 100, 101, 250, 1000])) for i in range(3000)] + [(1, 5), (1, 5), (None, 7), (9001, 0), (9002, None)]
    df = spark.createDataFrame(rows, "item long, size long").withColumn("container", F.lit("clash")).repartition(6)
    out = [r.asDict() for r in pack(df, 100, 8).collect()]
    assert sum(r["size"] for r in out) == sum(s or 0 for i, s in rows if i is not None)
    fill, pieces = {}, {}
    for r in out:
        fill[r["container"]] = fill.get(r["container"], 0) + r["size"]
        pieces.setdefault(r["item"], []).append((r["begin"], r["end"]))
        assert r["size"] == r["end"] - r["begin"] <= 100
    assert max(fill.values()) == 100 and 1 - sum(fill.values()) / (100 * len(fill)) < 0.03
    assert all(len(pieces[i]) == 1 for i, s in rows[:3000] if s <= 100 and i != 1) and [b for b, _ in sorted(pieces[rows.index(next(r for r in rows if r[1] == 250))])] == [0, 100, 200]
    assert pack(df.where("false")).count() == 0


def test_token_counts(spark):
    rows = [(1, "a plain sentence"), (2, ""), (3, None), (4, "word " * 20000), (5, "<|endoftext|>")]
    got = {r.item: r["size"] for r in token_counts(spark.createDataFrame(rows, "item long, text string"), *tokenizer_files()).collect()}
    assert got[1] == 3 and got[2] == got[3] == 0 and 20000 <= got[4] <= 20001 and got[5] > 1


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=30), st.lists(st.integers(0, 6), max_size=50))
def test_lcs(item, passage):
    masks = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    assert lcs(masks, len(item), passage) == plain_lcs(item, passage)


def plain_tiles(a, b):
    """Greedy string tiling by trying everything."""
    a, b, out = list(a), list(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and a[i + k] > 0:
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if not k:
            return out
        out.append(k)
        a[i : i + k], b[j : j + k] = [0] * k, [-1] * k


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=40), st.lists(st.integers(1, 5), min_size=1, max_size=25))
def test_tiles(text, item):
    a, b = np.array(text, np.int64), np.array(item, np.int64)
    got = Tiling(a, b).tiles()
    sizes = [s for _, _, s in got]
    assert sizes == sorted(sizes, reverse=True) and sizes[:1] == plain_tiles(text, item)[:1]
    assert all((a[d : d + s] == b[i : i + s]).all() for d, i, s in got)
    assert len({d + k for d, _, s in got for k in range(s)}) == len({i + k for _, i, s in got for k in range(s)}) == sum(sizes)
    assert sum(sizes) == sum(min(text.count(w), item.count(w)) for w in set(item)) == sum(plain_tiles(text, item))


ITEM = "the copper lantern hums at nine while seven gulls count lamps along a quiet pier and nobody asks why"


def leaks(text, item=ITEM):
    return [(i, s >= leakage.SHARE) for _, i, _, s in ItemIndex([(7, item)]).found([words(text)])]


def test_leak_limits():
    w = ITEM.split()
    noise = "some words before that mean nothing"
    assert leaks(f"{noise} {' '.join(w[3:15])} {noise}") and not leaks(f"{noise} {' '.join(w[3:14])} {noise}")
    assert leaks(f"{noise} {ITEM.upper().replace(' ', ' > ')}!! {noise}")
    swapped = [x if i % 6 else "other" for i, x in enumerate(w)]  # 4 of 19 words changed: too many
    assert not leaks(" ".join(swapped))
    kept = [x for i, x in enumerate(w) if i not in (4, 9, 14)] + ["end"]  # 16 of 19 kept in order
    assert leaks(" ".join(kept)) == [(7, True)]
    assert not leaks(" ".join(w[10:] + w[:10]).replace("quiet", "loud").replace("hums", "sings"))  # reordered and cut
    far = " ".join(w[:8]) + " filler" * 200 + " " + " ".join(w[8:])
    assert not [x for x in leaks(far) if x[1]]
    assert words("ﬁne Don’t STOP—now­1 é") == ["fine", "don", "t", "stop", "now1", "e"]


def test_finely_cut_items_are_leaks():
    w = ITEM.split()
    cut = " ".join(x + (" other" if k % 2 else "") for k, x in enumerate(w))
    assert leaks("noise before " * 40 + cut + " noise after" * 40) == [(7, True)]
    rng = random.Random(12)
    seen = set()
    for _ in range(600):
        item = [rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(5, 14))]
        text = [x for v in item if rng.random() > 0.12 for x in ([v] if rng.random() < 0.5 else [v, rng.choice("xyzab")])]
        text = ["y"] * rng.randrange(30) + text + ["z"] * rng.randrange(30)
        width = int(leakage.PASSAGE * len(item))
        best = max(plain_lcs(item, text[k : k + width]) for k in range(len(text)))
        want = best >= leakage.SHARE * len(item) - 1e-9
        got = leaks(" ".join(text), " ".join(item))
        assert (True in [s for _, s in got]) == want
        seen.add(want)
    assert seen == {True, False}


def test_leaked_items(spark, monkeypatch):
    opening = "Please read the following passage and answer in one word. "
    items = spark.createDataFrame([(1, opening + ITEM + ". Why?"), (2, opening + " ".join(f"u{i}" for i in range(40))), (3, None), (4, ""), (None, ITEM)], "item_id long, text string")
    docs = spark.createDataFrame([(10, f"a {ITEM} b " * 3), (11, opening * 3), (12, None), (13, ""), (None, ITEM), (14, "x " * 50_000 + " ".join(f"u{i}" for i in range(12))), (10, f"a {ITEM} b")], "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    for size in (16_000_000, 60):
        monkeypatch.setattr(leakage, "BLOCK_BYTES", size)
        assert sorted((r.doc_id, r.item_id) for r in leaked_items(docs, items).collect()) == [(10, 1), (14, 2)]
    assert leaked_items(docs.where("false"), items).count() == 0 and leaked_items(docs, items.where("false")).count() == 0


EN = ["The old relay near the gate stopped answering after the update.", "Nobody has claimed the device yet, so we opened a ticket.", "The queue grew while the lift was running.", "Our crew will measure once more tomorrow."]
DE = ["Das alte Relais hinter dem Tor antwortet seit dem Wechsel nicht mehr.", "Niemand hat das Gerät bisher abgeholt, deshalb wurde ein Ticket eröffnet.", "Die Warteschlange wuchs während der Aufzug stillstand.", "Unsere Schicht misst morgen noch einmal nach."]
FR = ["Le vieux relais derrière le quai ne répond plus depuis la mise à jour.", "Personne n'a encore réclamé l'appareil, et nous avons ouvert un ticket.", "La file est montée pendant que l'ascenseur était en marche.", "Notre équipe mesurera de nouveau demain."]


def test_sentences():
    text = 'Nothing else was found. At 17:06 it grew 2.5 times!\n\n{"k":74,"fp":"4b"}\n[bayar] retry=8 x=1\n Wrapped over\ntwo lines "here."'
    found = sentences(text)
    assert [text[a:b] for a, b, _ in found] == ["Nothing else was found.", "At 17:06 it grew 2.5 times!", 'Wrapped over\ntwo lines "here."']
    assert sentences(None) == sentences("") == sentences("123 456.") == []
    assert [w for _, _, w in sentences("Danke!")] == [["danke"]] and sentences("k=1 x=2") == []
    for text in ("今日は天気がいいです。明日は雨が降ります。", "旧继电器没有响应。没有人认领设备！"):
        parts = sentences(text)
        assert len(parts) == 2 and all(len(w) > 4 for _, _, w in parts) and [text[a:b] for a, b, _ in parts] == [x for x in (text[: parts[0][1]], text[parts[0][1] :])]
    assert len(sentences("อุปกรณ์เก่าไม่ตอบสนอง ไม่มีใครรับ")) == 1
    assert fold("Łódź") == "lodz" and fold("Straße") == "strasse"


def test_labels(spark):
    rows = [("eng",), ("en-GB",), (" DE ",), ("pl_PL",), ("und",), ("",), (None,), ("unknown",), ("xx1",), ("fre",), ("swa",), ("English",)]
    got = [r.x for r in spark.createDataFrame(rows, "l string").select(canonical_label(F.col("l")).alias("x")).collect()]
    assert got == ["en", "en", "de", "pl", None, None, None, None, "xx", "fr", "swa", "en"]


def test_languages(spark):
    rng = random.Random(2)
    rows, want = [], set()
    for i in range(240):
        own = ("en", EN) if i % 3 == 0 else ("de", DE) if i % 3 == 1 else ("fr", FR)
        other = ("de", DE) if own[0] != "de" else ("en", EN)
        text, label = " ".join(rng.sample(own[1], 3)), own[0]
        if i % 12 == 5:
            label = rng.choice([None, "und", "it", other[0]])
            want.add((i, own[0]))
        elif i % 12 == 7:
            text += " " + " ".join(rng.sample(other[1], 2))
            want |= {(i, own[0]), (i, other[0])}
        rows.append((i, text, label, f"kind-site{i % 4}"))
    rows += [(900, None, "en", "s"), (901, "", None, None), (902, "123 =4", None, "s"), (None, EN[0], "en", "s"), (903, " ".join(EN * 2000), "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("segment", F.lit("clash"))
    seg = segment_languages(df)
    assert all(0.3 < r.confidence <= 1 for r in seg.limit(500).collect())
    got = {(r.doc_id, r.lang) for r in corrected_languages(document_languages(seg)).collect()}
    assert len(got ^ want) <= 2, got ^ want
    assert segment_languages(df.where("false")).count() == 0


def test_unseen_words_are_judged_by_their_letters():
    counts = {w: {"de": 30} for w in "das relais wurde gesperrt schicht schaltung schrank".split()} | {w: {"en": 30} for w in "the relay was locked shift switching thing".split()}
    m = TextModel(counts)
    s = m.scores([["schaltschrank"], ["something"], []])
    assert m.languages == ["de", "en"] and s[0].argmax() == 0 and s[1].argmax() == 1 and (s[2] == 0).all()


@pytest.mark.parametrize("name", ["p2_found", "p6_found", "p7_found", "p8_packed", "p9_found", "p10_found"])
def test_queries_run(spark, name):
    from skysift.llm.queries import QUERIES

    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() >= 0
