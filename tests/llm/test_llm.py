import random
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrine.llm import canonical, leakage, linkage, packing, residue, sentences, truncated, variants
from vitrine.llm.names import from_wade, read
from vitrine.runtime import table

SF = "/root/testdata/sf0.001"
ARTIFACT = "seq long, museum_id int, object_id string, title string, artist string, dynasty string, period string, accession_number string, type string, material string, artist_bio string, artist_wikipedia_summary string, description string, provenance string"


def artifacts(spark, rows):
    names = [c.split()[0] for c in ARTIFACT.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ARTIFACT)


# ---- 1 ----


def corpus():
    rnd = random.Random(5)
    motifs = ["pine and rocks", "a stone bridge", "wild geese", "lotus scrolls", "orchids"]
    whole = [" ".join(f"The {rnd.choice(['bowl', 'vase', 'jar'])} shows {rnd.choice(motifs)} near No. {rnd.randrange(99)} of the {rnd.choice(['store', 'annex', 'vault'])}." for _ in range(rnd.randrange(2, 6))) for _ in range(400)]
    cut = [t[: rnd.randrange(30, len(t) - 8)] for t in whole[:60]]
    cut = [t for t in cut if not t.rstrip().endswith(".")]
    return whole[60:], cut


def test_truncation_by_held_out_accuracy(spark):
    whole, cut = corpus()
    rows = [{"seq": i, "museum_id": 1, "description": t} for i, t in enumerate([*whole, *cut])]
    rows += [{"seq": 10_000, "description": whole[0][:50] + "…"}, {"seq": 10_001, "description": whole[1][:40] + " &quo"}, {"seq": 10_002, "description": None}, {"seq": 10_003, "description": " "}, {"seq": 10_004, "description": "HTTP 404 – page gone"}]
    got = {r.seq for r in truncated.cut_off(artifacts(spark, rows)).collect()}
    want = set(range(len(whole), len(whole) + len(cut)))
    assert {10_000, 10_001} <= got and not got & {10_002, 10_003, 10_004}
    found = got & set(range(10_000))
    assert len(found & want) / len(want) >= 0.9 and len(found & want) / max(1, len(found)) >= 0.9


def test_truncation_of_nothing(spark):
    assert truncated.cut_off(artifacts(spark, [])).count() == 0
    assert truncated.rates(artifacts(spark, [])).count() == 0
    copies = artifacts(spark, [{"seq": i, "museum_id": None, "description": "One whole text. And its end."} for i in range(30)])
    assert truncated.cut_off(copies).count() == 0
    assert {r.texts for r in truncated.rates(copies).collect()} == {0, 30}


# ---- 2 ----


@given(st.lists(st.text("abcdef ghij", min_size=1, max_size=60), min_size=1, max_size=8))
@settings(max_examples=40, deadline=None)
def test_simhash_against_brute_force(texts):
    want = []
    for t in texts:
        t = t if len(t) >= 4 else t.ljust(4)
        hs = []
        for i in range(len(t) - 3):
            g = ord(t[i])
            for k in range(1, 4):
                g = (g * 1_000_003 + ord(t[i + k])) % 2**64
            for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
                g = (g ^ (g >> 33)) * m % 2**64
            hs.append(g ^ (g >> 33))
        want.append(sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)))
    assert residue.simhashes(texts).tolist() == want


def test_residue_spreads_to_near_copies_and_spares_prose(spark):
    page = "This site works best with scripts turned on; activate them in your browser settings."
    near = "This site works best when scripts turned on; activate them all in your browser settings."
    nearer = "This site works fine when scripts turned on"
    rows = [
        {"seq": 1, "description": page}, {"seq": 2, "description": near}, {"seq": 3, "description": "The bowl weighs 3 kg, i.e. more ${NAME} its lid."}, {"seq": 4, "description": "The bowl weighs 3 kg, i.e. more than its lid."},
        {"seq": 5, "provenance": "502 Not Found."}, {"seq": 6, "provenance": "Page 404 of the old ledger lists the same bowl."}, {"seq": 7, "provenance": "Not recorded"}, {"seq": 8}, {"seq": 9, "description": ""}, {"seq": 1, "description": page}, {"seq": 10, "description": "真品。此处填写说明文字"},
        {"seq": 11, "description": "The inscription in seal script is required reading for students of Qing epigraphy."}, {"seq": 12, "description": "It came [2] from @@owner name@@ in 1920."}, {"seq": 13, "description": "nunc elit alet dolor urna nunc sed"}, {"seq": 14, "provenance": "None, None, None"},
        {"seq": 15, "provenance": "none known before 1930"}, {"seq": 16, "description": nearer}, {"seq": 17, "description": "[Please enable JavaScript to view this page.]"},
    ]
    df = artifacts(spark, rows).withColumn("h", F.lit(1)).withColumn("hash", F.lit(1))
    got = {(r.seq, r.field_name) for r in residue.residue(df).collect()}
    want = {(k, "description") for k in (1, 2, 3, 10, 12, 13, 17)} | {(5, "provenance"), (14, "provenance")}
    chain = {(16, "description")}  # similar to what is similar to a trusted text
    assert got - chain == want
    assert {(r.seq, r.field_name) for r in residue.residue(df, rounds=0).collect()} < want, "without the spread near copies are lost"
    assert residue.residue(artifacts(spark, [])).count() == 0
    assert residue.residue(artifacts(spark, rows[3:4])).count() == 0


@pytest.fixture(scope="module")
def alike():
    """520 made texts with their pairs of the wanted similarity."""
    rnd = random.Random(4)
    words = ["bowl", "lotus", "heron", "willow", "bridge", "ivory", "garden", "scroll", "mist", "plum", "crane", "ink", "carp", "jade", "silk", "river"]
    texts = []
    for n in range(40):
        base = ["error", "code", "404", "on", *rnd.choices(words, k=rnd.randrange(12, 24)), str(n)]
        texts.append(" ".join(base))
        for _ in range(12):
            near = [w for w in base if w not in ("error", "code", "404")]
            for _ in range(rnd.randrange(1, 3)):
                near[rnd.randrange(len(near))] = rnd.choice(words)
            texts.append(" ".join(near))
    pairs = [(i, j) for i, j in combinations(range(len(texts)), 2) if residue.jaccard(texts[i], texts[j]) >= residue.SIMILARITY]
    return texts, pairs


def test_residue_spreads_to_every_similar_text_by_brute_force(spark, alike):
    texts, pairs = alike
    df = spark.createDataFrame([(i, t, t.startswith("error code")) for i, t in enumerate(texts)], "h long, skeleton string, label boolean")
    want = {i for i, t in enumerate(texts) if t.startswith("error code")}
    trusted = len(want)
    while grown := {x for p in pairs for x in p if want & set(p)} - want:
        want |= grown
    assert len(want) > 2 * trusted and {r.h for r in residue.label_skeletons(df).collect()} == want
    assert len(residue.label_skeletons(df, rounds=1).collect()) < len(want)


def test_tables_alone_meet_most_near_copies(spark, alike):
    """Recall of the SimHash tables against brute force, before the prefix filter finds the rest."""
    texts, pairs = alike
    hashes = spark.createDataFrame([(i, h) for i, h in enumerate(residue.simhashes(texts).astype("int64").tolist())], "i int, hash long")
    keys = hashes.select("i", residue._keys("hash").alias("key"))
    met = {(r.i, r.j) for r in keys.join(keys.withColumnRenamed("i", "j"), "key").where("i < j").select("i", "j").distinct().collect()}
    assert sum(p in met for p in pairs) / len(pairs) > 0.8


def test_two_blocks_meet_within_six_bits():
    rnd = random.Random(2)
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), residue.SURE):
            b ^= 1 << bit
        key = lambda x: {tuple((i, x >> 8 * i & 255) for i in chosen) for chosen in combinations(range(residue.BLOCKS), residue.KEYED)}
        assert key(a) & key(b)


# ---- 3 ----


def test_linkage(spark):
    objects, records = [], []
    rnd = random.Random(3)
    adj, obj, motif, place = ("Lobed", "Carved", "Gilded", "Square", "Painted"), ("bowl", "vase", "plaque", "censer"), ("orchids", "carp", "gourds", "waves", "cranes"), ("garden", "harvest", "dusk", "mist")
    eras = ["Ming（明）", "Qing（清）", "Tang（唐）"]
    makers = ["Wu Bolin", "Qian Xinpu", "Ann B. Fieldstone", "Shu Tangmo"]
    for i in range(400):
        t = f"{rnd.choice(adj)} {rnd.choice(obj)} with {rnd.choice(motif)} at {rnd.choice(place)}"
        objects.append({"seq": i, "museum_id": 1 + i % 2, "object_id": f"o{i}", "title": t, "artist": rnd.choice(makers), "dynasty": rnd.choice(eras), "accession_number": f"{1900 + i % 100}.{i % 37 + 1}.{i % 17 + 1}"})
    for i in range(0, 200):
        o = objects[i]
        y, lot, part = o["accession_number"].split(".")
        n = [o["accession_number"], f"Inv. {y[2:]}/{int(lot):04d}/{part}", f"acc. {y} {lot} {part}"][i % 3]
        records.append((i, o["title"].lower() if i % 2 else "The " + o["title"], o["dynasty"][:-3], n, o["artist"]))
    records += [(1000 + i, f"Embroidered robe with peony {i}", "Yuan", f"1950.{i}.{30 + i}", "Nobody Known") for i in range(100)] + [(5000, None, None, None, None), (5001, "", "", "", "")]
    r = spark.createDataFrame(records, "rec_id long, title string, period string, objectnumber string, people string").withColumn("id", F.lit(1)).withColumn("a", F.lit(2))
    vocab = table(spark, SF, "vocab_term")
    got = linkage.link(r, artifacts(spark, objects + objects[:20]), vocab).collect()
    pairs = {(x.rec_id, x.object_id) for x in got}
    want = {(i, f"o{i}") for i in range(200)}
    assert len(pairs) == len(got) and len(pairs & want) >= 190 and len(pairs - want) <= 4 and all(0.5 <= x.confidence <= 1 for x in got)
    assert linkage.link(r.limit(0), artifacts(spark, objects[:3]), vocab).count() == 0
    assert linkage.link(r, artifacts(spark, []), vocab).count() == 0


def test_blocking_brings_similar_entries_together(spark):
    maker = "Eleanor E. Hartelwick"
    rows = [
        (0, "Burnished plaque with wild geese along a river", "2017.148.10", maker, ""), (1, "Burnished plaque wth wild geese along a river", None, maker, ""),
        (2, "Carved bowl", "2011.5.3", maker, "Ming"), (3, "A carved bowl", None, maker, ""), (4, "Bowl carved with carp", None, maker, ""), (5, "Vase", "1999.7.1", maker, "Ming"), (6, "The vase", None, maker, "Ming"),
        (7, None, "1950.31.8", None, "Ming"), (8, None, "1950.97.8", None, "Ming"), (9, None, None, maker, "Ming"), (10, "Vase", None, None, "Ming"),
    ]
    df = spark.createDataFrame(rows, "id long, title string, number string, maker string, era string")
    keys = {r.id: set(r["keys"]) for r in linkage.standardise(df, "id", {c: c for c in ("title", "number", "maker", "era")}, [(1, "ming")]).collect()}
    assert {(i, j) for i, j in combinations(range(len(rows)), 2) if keys[i] & keys[j]} == {(0, 1), (2, 3), (2, 4), (3, 4), (5, 6), (7, 8)}


@pytest.mark.parametrize(("a", "b", "level"), [("F1955.297.2", "acc. F.55/297/2", 4), ("1975.100.2", "75 0100 02", 4), ("1.2.3", "L657.7", 2), (None, "1.2.3", 2), ("1977.22.3", "1977.22.1", 3), ("1977.22.3", "1977.22.41", 1), ("1977.22.3", "1955.9.7", 0), ("F1955.297.2", "1955.297.2", 3)])
def test_numbers(a, b, level):
    assert linkage.number_level(linkage.number(a), linkage.number(b)) == level


def test_another_leaf_is_no_match():
    a, b = linkage.title("Cranes in mist, leaf 2 of 7"), linkage.title("Cranes in mist, leaf 3 of 7")
    assert linkage.title_level(a[0], b[0], a[1], b[1])[0] == -1


# ---- 5 ----


def test_set_join_against_brute_force(spark):
    rnd = random.Random(7)
    left = [(i, "p", sorted({rnd.randrange(30) for _ in range(rnd.randrange(1, 12))})) for i in range(120)]
    right = [(i, "p", sorted({rnd.randrange(30) for _ in range(rnd.randrange(1, 12))})) for i in range(60)]
    as_df = lambda rows, k: spark.createDataFrame([(i, p, [str(x) for x in t]) for i, p, t in rows], f"{k} long, part string, tokens array<string>")
    got = {(r.id, r.rid) for r in canonical.set_join(as_df(left, "id"), as_df(right, "rid"), 0.4).collect()}
    want = {(i, j) for i, _, x in left for j, _, y in right if len(set(x) & set(y)) / len(set(x) | set(y)) >= 0.4}
    assert got == want


def test_canonical(spark):
    values = ["Bowl", "Pottery", "pottrey", "  Ceramic ", "Ceramic?", "Fossil", "fan, folding", "Arms-and-armor", "", None, "Ceramic"]
    rows = [{"seq": i, "type": v, "dynasty": d} for i, (v, d) in enumerate(zip(values, ["Qng dynasty", "the Ming era", "Edo period", "清代", "Ch'ing dynassty", "Qing（清）", "Former Hn", "undated", None, "", "Qing dynasty (1644-1911)"]))]
    got = {(r.seq, r.field_name): r.term_id for r in canonical.map_values(artifacts(spark, rows).withColumn("part", F.lit("x")), table(spark, SF, "vocab_term")).collect()}
    assert {k[0]: v for k, v in got.items() if k[1] == "type"} == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 0, 6: 20, 7: 11}
    assert {k[0]: v for k, v in got.items() if k[1] == "dynasty"} == {0: 68, 1: 67, 2: 0, 3: 68, 4: 68, 6: 53, 7: 0, 10: 68}
    assert canonical.map_values(artifacts(spark, []), table(spark, SF, "vocab_term")).count() == 0
    assert {r.term_id for r in canonical.map_values(artifacts(spark, rows), table(spark, SF, "vocab_term").limit(0)).collect()} == {0}


@given(st.text("abc", max_size=8), st.text("abc", max_size=8))
@settings(max_examples=200, deadline=None)
def test_osa_against_recursion(a, b):
    from functools import cache

    @cache
    def d(i, j):
        if not i or not j:
            return i + j
        best = min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            best = min(best, d(i - 2, j - 2) + 1)
        return best

    assert canonical.osa(a, b, 9) == d(len(a), len(b))
    assert canonical.osa(a, b, 2) == min(3, d(len(a), len(b)))


# ---- 7 ----


@given(st.text("abcd", min_size=6, max_size=14), st.integers(0, 3), st.integers(0, 13), st.sampled_from("abcdx"))
@settings(max_examples=400, deadline=None)
def test_one_edit_meets_in_the_index(a, edit, at, c):
    at %= len(a)
    b = [a[:at] + c + a[at + 1 :], a[:at] + c + a[at:], a[:at] + a[at + 1 :], a[:at] + a[at + 1 : at + 2] + a[at : at + 1] + a[at + 2 :]][edit]
    meets = set(variants.index_keys(a, "s")) & variants.probe_keys(b, "s", True) or set(variants.index_keys(b, "s")) & variants.probe_keys(a, "s", True)
    assert meets or len(b) < variants.SHORTEST


@pytest.mark.parametrize(("wade", "pinyin"), [("ch'ang", "chang"), ("chang", "zhang"), ("hsüeh", "xue"), ("ts'en", "cen"), ("ch'iu", "qiu"), ("yü", "yu"), ("yu", "you"), ("jung", "rong"), ("k'o", "ke"), ("lo", "luo"), ("chih", "zhi"), ("i", "yi"), ("kuei", "gui"), ("t'ien", "tian"), ("xue", None)])
def test_romanisation(wade, pinyin):
    assert from_wade(wade) == pinyin


def test_variants(spark):
    people = [
        (1, "Duan Hexian", 1189, 1243), (2, "Duan He-xian", 1189, 1243), (3, "Tuan, Ho-hsien", None, None), (4, "Duan Hxeian", 1189, None), (5, "Duan H.X.", 1189, 1243), (6, "段鹤贤（Duan Hexian）", 1189, 1243), (7, "段鹤贤", None, None),
        (10, "Duan Hexian", 1400, 1450), (11, "Duan H.", 1400, 1450),
        (20, "Edmund L. Fieldstone", 1850, 1900), (21, "Fieldstone, E.L.", 1850, None), (22, 'Edmund "Ned" Fieldstone', 1850, 1900), (23, "Ned Fieldstone", 1850, 1900), (24, "Edmund S. Fieldstone", 1850, 1900), (25, "attr. Edmund L. Feildstone", 1850, 1900),
        (30, "Field & Stone Company", 1700, 1750), (31, "Field, Stone & Co.", None, None), (32, "Messrs. Field & Stone", 1700, None), (40, "Bofu Lacquer Guild", 1678, 1724), (41, "The Bofu Lacquer Gld.", None, None), (50, None, 1, 2), (51, "", None, None), (52, "???", None, None),
    ]
    df = spark.createDataFrame(people, "alias_id long, alias string, birth_year int, death_year int").withColumn("a", F.lit(1)).withColumn("node", F.lit(1))
    got: dict[int, set[int]] = {}
    for r in variants.variant_pairs(df).collect():
        assert r.alias_id_a < r.alias_id_b
        got.setdefault(r.alias_id_a, set()).add(r.alias_id_b)
    assert got.get(1, set()) >= {2, 4, 5, 6} and not got.get(1, set()) & {10, 11} and got.get(10) == {11}
    assert got.get(6, set()) >= {7}
    assert {21, 22, 23, 25} <= got.get(20, set()) and got.get(30) == {31, 32} and got.get(40) == {41}
    assert not {50, 51, 52} & set(got) and variants.variant_pairs(df.limit(0)).count() == 0
    assert read(None) == [] and read("???") == []


@pytest.mark.parametrize("order", [(1, 2, 3), (1, 3, 2)])
def test_undated_names_chain_homes(spark, order):
    chinese, romanised, pseudonym = order
    people = [(chinese, "段鹤贤", 1189), (romanised, "Duan Hexian", 1189), (pseudonym, "Hexi Shanren", 1189), (4, "段鹤贤（Duan Hexian）", None), (5, "Duan Hexian (hao Hexi Shanren)", None), (6, "Hexi Shanren", 1400)]
    df = spark.createDataFrame([(*p, None) for p in people], "alias_id long, alias string, birth_year int, death_year int")
    assert {tuple(r) for r in variants.variant_pairs(df.where("alias_id < 6")).collect()} == set(combinations(range(1, 6), 2))
    got = {tuple(r) for r in variants.variant_pairs(df).collect()}
    assert not any(6 in p for p in got) and (chinese, 4) in got


# ---- 8 ----


def test_hilbert_visits_every_cell_by_steps_of_one():
    cells = np.array(np.meshgrid(*[range(8)] * 3, indexing="ij")).reshape(3, -1).T
    order = cells[np.argsort(packing.hilbert(cells, 3))]
    assert len(set(packing.hilbert(cells, 3))) == 512 and set(np.abs(np.diff(order, axis=0)).sum(1)) == {1}


@given(st.lists(st.integers(0, 350), max_size=200))
@settings(deadline=None)
def test_packer_loses_nothing(sizes):
    p = packing.Packer(100, 8)
    out = [(i, *row) for i, s in enumerate(sizes) for row in p.put(s)]
    per: dict[int, int] = {}
    for i, c, piece, at, n in out:
        per[c] = per.get(c, 0) + n
        assert n <= 100 and (piece == 0 or sizes[i] > 100)
    assert all(v <= 100 for v in per.values())
    for i, s in enumerate(sizes):
        mine = [(at, n) for j, _, _, at, n in out if j == i]
        assert sum(n for _, n in mine) == s and mine == sorted(mine)


def test_pack(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(spark.createDataFrame([(1, None), (2, ""), (3, "word " * 5000), (4, "same"), (4, "same")], "doc_id long, text string")).withColumn("place", F.lit(1)).withColumn("tokens", F.lit(1))
    rows = packing.pack(docs).collect()
    per: dict[int, int] = {}
    for r in rows:
        per[r.container] = per.get(r.container, 0) + r.tokens
    assert max(per.values()) <= packing.CAPACITY and {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    long = sorted((r.piece, r.start_token, r.tokens) for r in rows if r.doc_id == 3)
    assert len(long) > 1 and all(b[1] == a[1] + a[2] for a, b in zip(long, long[1:]))
    assert sum(per.values()) / (len(per) * packing.CAPACITY) > 0.9
    assert packing.pack(docs.limit(0)).count() == 0


# ---- 9 ----


def test_leaks(spark):
    item = "According to ledger 84, Walter Field paid 22 coins for begonias, whereas Bo Binqiu paid 14 for the miniature box shown in 1896."
    zh = "账册第5页称宁棠县窑一日可烧7件素面镜，而康奇欣却只取走绘有海浪的37件，请说明颈部的去向。"
    tests = spark.createDataFrame([(1, item), (2, zh), (3, None), (4, "")], "item_id long, text string").withColumn("lang", F.lit("en"))
    words = item.split()
    docs = [
        (1, "Before. " + item + " After."), (2, " ".join(words[3:16]).upper()), (3, " ".join(words[3:13])), (4, item.replace("begonias", "bегonias").replace("miniature", "minature").replace(" ", "\n")), (5, "中文" + zh[2:26]), (6, zh[:14]), (7, None), (8, ""),
        (9, item.replace("ledger 84", "ledger 85").replace("coins for", "coins or for")), (10, (item + " filler text of another kind. ") * 300),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("words", F.lit(1))
    got = {(r.item_id, r.doc_id): r for r in leakage.leaks(df, tests).collect()}
    assert set(got) == {(1, 1), (1, 2), (1, 4), (2, 5), (1, 9), (1, 10)}
    r = got[1, 1]
    assert docs[0][1][r.start_at : r.end_at] == item[:-1] and r.words == len(words)
    assert leakage.leaks(df.limit(0), tests).count() == 0 and leakage.leaks(df, tests.limit(0)).count() == 0


def test_leaks_against_brute_force():
    rnd = random.Random(9)
    vocab = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu", "pre") for b in ("ron", "sel", "tave", "nix", "dor")]
    items = leakage.items_of([(i, " ".join(rnd.choice(vocab) for _ in range(40))) for i in range(20)])
    a = leakage.automaton(items)
    for _ in range(60):
        it = rnd.choice(items)
        k, n = rnd.randrange(20), rnd.randrange(5, 20)
        doc = " ".join([*(rnd.choice(vocab) for _ in range(15)), *it.words[k : k + n], *(rnd.choice(vocab) for _ in range(15))])
        got = {key for key, *_ in leakage.passages(doc, items, a)}
        w = doc.split()
        want = {i.key for i in items if any(w[p : p + 12] == i.words[q : q + 12] for p in range(len(w) - 11) for q in range(len(i.words) - 11))}
        assert want <= got


# ---- 10 ----


@pytest.mark.parametrize(
    "parts",
    [
        ["Dr. Xu saw it at 9 a.m. on Jan. 3.", "Mr. A. B. Cen left."], ['"Sold!" cried the man, and left.', 'He wrote: "No. 5, ink."', "(It was 3.5 cm.)", "Who, after all, knew?!"], ["A loan to the U.S.A. was refused.", "It was bought from Xu and Sons, Inc.", "pH 5.3 was read."],
        ["Am 3. Mai 1913 kam es.", "Xu notierte: „Der Rand ist neu.“", "„Ist das echt?“, fragte er.", "Siehe Abb. 5 und Nr. 7."], ["Le Dr Xu écrivit : « La base est moderne. »", "« Est-ce une copie ? » demanda-t-il.", "Voir p. ex. la fig. 9."], ["¿Por qué falta la tapa?", "El Sr. Xu la vio, inv. núm. 5."],
        ["Найден в 1948 г. при осмотре.", "«Это подделка?» — спросил он.", "Записал: «Пуст.»"], ["डॉ. शर्मा ने देखा।", '"यह किसका है?" रक्षक ने पूछा।', "पृ. 5 पर है।"],
    ],
)
def test_sentences(parts):
    text = " ".join(parts)
    assert [text[a:b] for a, b in sentences.sentences(text)] == parts
    wrapped = text.replace(" ", "\n", 3)
    assert [wrapped[a:b].replace("\n", " ") for a, b in sentences.sentences(wrapped)] == parts


def test_sentences_without_spaces_or_marks():
    zh = ["“真是好器！”雷欣叹道，“可惜边框已残。”", "“此器出自露县吗？”何宁在信中问道。", "No. 8号柜内另有一砚。", "这件罐……据说三次易主。"]
    assert ["".join(zh)[a:b] for a, b in sentences.sentences("".join(zh))] == zh
    ja = ["「箱は別物だ。」と手紙にある。", "なぜ銘がないのだろうか。"]
    assert ["".join(ja)[a:b] for a, b in sentences.sentences("".join(ja))] == ja
    assert len(sentences.sentences("圈足略有磨损 1969年入藏 白釉碗绘松石")) == 3
    assert len(sentences.sentences("ฝาปิดถูกเปลี่ยน 13 ปีก่อน กล่องไม้เดิมสูญหายไป")) == 2


def test_sentence_layout():
    text = "Condition\n\nThe lid\nis new. It fits.\n- one part\n* two parts\n\nEnd"
    assert [text[a:b] for a, b in sentences.sentences(text)] == ["Condition", "The lid\nis new.", "It fits.", "- one part", "* two parts", "End"]
    assert sentences.sentences(None) == sentences.sentences(" \n ") == []
    assert len(sentences.sentences("One is here. " * 4000)) == 4000


@given(st.text("aB.?! \n\"'()。”“", max_size=80))
@settings(max_examples=200, deadline=None)
def test_sentences_keep_every_character(text):
    spans = sentences.sentences(text)
    at = 0
    for a, b in spans:
        assert a >= at and b > a and not text[at:a].strip() and text[a:b] == text[a:b].strip()
        at = b
    assert not text[at:].strip()


def test_sentence_rows(spark):
    df = spark.createDataFrame([(1, "Aa bb. Cc dd."), (2, None), (3, ""), (1, "Aa bb. Cc dd.")], "doc_id long, text string").withColumn("sent_no", F.lit(1))
    assert sorted(map(tuple, sentences.split_sentences(df).collect())) == [(1, 1, 0, 6)] * 2 + [(1, 2, 7, 13)] * 2
    assert sentences.split_sentences(df.limit(0)).count() == 0


def test_queries(spark):
    from vitrine.llm.queries import QUERIES

    assert {f"p{n}_found" for n in (1, 2, 3, 5, 7, 9, 10)} <= set(QUERIES) and "p8_containers" in QUERIES
    for n in (1, 2, 3, 5, 7, 9, 10):
        assert QUERIES[f"p{n}_found"](spark, SF).count() > 0
