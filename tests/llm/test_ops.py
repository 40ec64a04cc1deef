"""Small fixtures against brute force: nulls, empty texts, ties, repeated rows, empty tables, extra columns."""

import gzip
import hashlib
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wirequery.llm import common, components, decontam, fingerprint, jaccard, langid, linededup, mixing, ppm, quality, toxicity, warc

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa la mu nu xi omi pi rho sigma tau ups".split()


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    texts += [t.replace("alpha", "ALPHA") for t in texts[:5]] + [t + " more" for t in texts[5:12]] + [None, "", " \n ", texts[0], "é ñ"]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, len(t or ""), i, 0.5) for i, t in enumerate(texts)] + [(None, "no key at all in this row", "en", "s1", 1, 0, 0.5)]
    return common.cut(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score long, mix_rate double"), "test")


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    w = [x for x in w.replace(b"\t", b" ").replace(b"\n", b" ").split(b" ") if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_jaccard_is_exact(docs):
    rows = [(r.doc_id, shingles(r.text)) for r in docs.collect()]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    want = {}
    for k, (i, s) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if root[m] == root[k] and rows[m][0] is not None]
        want[i] = (len(s), min(ids, default=None))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.groups(docs).collect()} == want
    assert jaccard.groups(docs.limit(0)).count() == 0
    kept = jaccard.one_each(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id is null").count() == 1


def linked_components(texts, percent):
    """The least index that is reachable by links, for each text, by comparing all pairs."""
    held = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(held):
        for j, b in enumerate(held[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return dict(enumerate(root))


def watched(monkeypatch):
    """Rows of the tables that are written from now on, by name."""
    rows, cut = {}, common.Scope.cut

    def count(self, df, name):
        out = cut(self, df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(common.Scope, "cut", count)
    return rows


def frame(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)


@pytest.mark.parametrize("percent", [60, 75, 90])
def test_jaccard_near_the_threshold(spark, percent):
    rng = random.Random(percent)
    texts = []
    for n in (6, 9, 20, 40, 70, 150, 258, 300, 530):
        base = [f"w{rng.randrange(4 * n)}" for _ in range(n + 4)]
        for k in range(6):  # a run of words replaced, words cut off or added, so that about the share of the threshold stays
            run = max(0, round(n * rng.uniform(0.3, 1.7) * (1 - percent / 100) / (1 + percent / 100)))
            at = rng.randrange(n + 4 - min(run, n))
            more = [f"x{n}.{k}.{i}" for i in range(run)]
            texts.append(" ".join((base[:at] + more + base[at + run :], base[: n + 4 - 2 * run], base + more + more)[k % 3]))
    texts += rng.sample(texts, 8)
    got = {r.doc_id: r.component_id for r in jaccard.groups(frame(spark, texts), percent).collect()}
    assert got == linked_components(texts, percent)


def test_jaccard_fetches_long_texts_only_if_sketches_are_close(spark, monkeypatch):
    passages = [" ".join(f"p{k}.{i}" for i in range(600)) for k in range(10)]
    texts = [f"{passages[k]} {passages[(k + 1) % 10]}" for k in range(10)]  # each shares half of it with two others
    texts.append(" ".join(texts[4].split()[:-40]))
    rows = watched(monkeypatch)
    got = {r.doc_id: r.component_id for r in jaccard.groups(frame(spark, texts)).collect()}
    assert got == linked_components(texts, 75) == {k: k for k in range(10)} | {10: 4}
    assert rows["texts"] == 2


def test_jaccard_lists_only_keys_that_a_link_may_share_first(spark, monkeypatch):
    same, own = ([f"{c}{i}" for i in range(160)] for c in "so")
    texts = [" ".join(same + own[k : k + 40]) for k in (0, 50)]  # 160 of 240 words in common: 0.65
    rows = watched(monkeypatch)
    assert [r.component_id for r in jaccard.groups(frame(spark, texts)).orderBy("doc_id").collect()] == [0, 1]
    assert rows["lists"] == 0
    texts = [" ".join(same + own[k : k + 18]) for k in (0, 50)]
    assert [r.component_id for r in jaccard.groups(frame(spark, texts)).orderBy("doc_id").collect()] == [0, 0]


def test_one_each_tells_rows_apart_by_key_and_text(spark):
    a, b = "one two three four five six seven eight", "nothing of that kind is in this other text"
    rows = [(1, a, "x"), (1, b, "y"), (2, a, "z"), (None, a, "u"), (None, "quite another text with no key at all", "v"), (1, a, "w"), (3, None, "p"), (3, None, "q"), (4, "", "r")]
    d = spark.createDataFrame(rows, "doc_id long, text string, cls string")
    kept = [tuple(r) for r in jaccard.one_each(d).collect()]
    assert [r[2] for r in sorted(kept, key=repr) if r[1] != a] == [r[2] for r in sorted((r for r in rows if r[1] != a), key=repr)]
    assert len([r for r in kept if r[1] == a]) == 1 and next(r for r in kept if r[1] == a)[0] == 1
    assert jaccard.one_each(d.limit(0)).count() == 0 and jaccard.one_each(d).columns == d.columns


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 31)} | {101: 100}


def test_mixing(docs):
    out = mixing.mix(docs, {"s1": 3.0, "s2": 1.0}).collect()
    assert {r.source for r in out} <= {"s1", "s2"} and out == mixing.mix(docs.repartition(3), {"s1": 3.0, "s2": 1.0}).collect()
    assert mixing.mix(docs.limit(0)).count() == 0
    assert len(out[0]) == len(docs.columns) + 2


def test_mixing_rate(spark):
    d = spark.range(4000).selectExpr("id as doc_id", "'x' as text", "if(id < 40, 'small', 'large') as source")
    n = {r.source: r["count"] for r in mixing.mix(d, {"small": 1, "large": 1}).groupBy("source").count().collect()}
    assert abs(n["small"] - 2000) < 200 and abs(n["large"] - 2000) < 200


def test_line_dedup(spark):
    texts = [f"own text number x{chr(97 + i)} here\nCopyright {i} of us\nsame line" for i in range(6)] + ["same line", None, "", "a\n\nb"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.dedup(d, 5).collect()}
    assert got[0] == texts[0] and got[3] == "own text number xd here" and got[6] == "" and got[7] is None and got[9] == "a\n\nb"
    assert linededup.dedup(d.limit(0)).count() == 0
    copies = spark.createDataFrame([(i, "one and the same\ntext") for i in range(9)], "doc_id long, text string")
    assert linededup.dedup(copies, 5).filter("n_dropped > 0").count() == 0


def test_line_templates(spark):
    line = "the server at {} answered the call in good time today"
    d = spark.createDataFrame([(i, line.format(w) + f"\n{w}") for i, w in enumerate(WORDS[:8])], "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.dedup(d, 5).collect()}
    assert got[0].startswith("the server") and got[5] == WORDS[5]


def test_line_templates_of_frequent_values(spark):
    line = "the server at {} answered the call from {} in good time today"
    pairs = [(a, b) for a in WORDS[:8] for b in WORDS[8:16]]
    for n in (8, 64):
        rows = random.Random(n).sample(pairs, n)
        d = spark.createDataFrame([(i, line.format(a, b) + f"\n{a} {b}") for i, (a, b) in enumerate(rows)], "doc_id long, text string")
        got = {r.doc_id: r.text for r in linededup.dedup(d, 5).collect()}
        assert got == {i: (line.format(a, b) + "\n" if i == 0 else "") + f"{a} {b}" for i, (a, b) in enumerate(rows)}


def linededup_plain(rows, min_texts=5):
    """The rule in plain Python: {text: lines to drop}."""
    owner = {}
    for i, t in rows:
        if t:
            owner[t] = min(owner.get(t, i), i)
    tokens = lambda l: tuple("<*>" if any(c in "0123456789" for c in x) else x for x in l.split())
    seen = {(t, l, tokens(l)) for t in owner for l in t.split("\n") if l.strip()}
    leaf = lambda w: (len(w), *w[: linededup.LEAD])
    texts, at = {}, {}
    for t, _, w in seen:
        texts.setdefault(leaf(w), set()).add(t)
        for k, x in enumerate(w):
            at.setdefault((leaf(w), k, x), []).append((t, w))

    def template(w):
        if len(texts[leaf(w)]) < min_texts or len(w) < linededup.GENERAL:
            return w
        n = [len({*at[leaf(w), k, x]}) if k >= linededup.LEAD else 1 << 48 for k, x in enumerate(w)]
        n = [x if x >= min_texts else 0 for x in n]
        support = sorted(n, reverse=True)[math.ceil(len(w) * linededup.CONSTANT) - 1]
        return w if support < min_texts else tuple(x if m >= support * linededup.SHARE else "<*>" for x, m in zip(w, n))

    groups, drop = {}, {}
    for t, l, w in seen:
        groups.setdefault((min_texts, leaf(w), template(w)), set()).add((owner[t], t, l))
        if sum(x != "<*>" for x in w) >= linededup.LONG:
            groups.setdefault((linededup.LONG_TEXTS, w), set()).add((owner[t], t, l))
    for (least, *_), g in groups.items():
        if len({t for _, t, _ in g}) >= least:
            for _, t, l in g:
                if t != min(g)[1]:
                    drop.setdefault(t, set()).add(l)
    return drop


def test_line_dedup_against_plain_python(spark):
    rng = random.Random(5)
    fields = [["red", "blue"], WORDS[:4], WORDS[4:12], [f"x{k}" for k in range(9)]]
    forms = ["we saw the {} car of {} go by {} at gate {} on that same day", "we saw the {} cat of {} sit by {} near hut {} on some other day", "log of the {} call {} to {} came {}"]
    texts = [None, "", " \n "] + ["\n".join(rng.choice(forms).format(*map(rng.choice, fields)) for _ in range(rng.randrange(1, 4))) for _ in range(150)]
    long = ["it was long " + " ".join(rng.choice(WORDS) for _ in range(n)) for n in (46, 47, 60, 60, 60)]
    texts += [f"{rng.choice(WORDS)} {k} {k}\n" + "\n".join(rng.sample(long, 2)) for k in range(8)]
    rows = list(enumerate(texts + texts[10:20]))
    drop = linededup_plain(rows)
    assert len(drop) > 100
    want = {i: (t and "\n".join(l for l in t.split("\n") if l not in drop.get(t, ())), len(drop.get(t, ()))) for i, t in rows}
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.text, r.n_dropped) for r in linededup.dedup(d.repartition(3), 5).collect()} == want


def test_long_lines_recur_from_two_texts(spark):
    long, other, short = (" ".join(f"{c}{rng.choice(WORDS)}" for _ in range(n)) for rng in (random.Random(6),) for c, n in (("a", 60), ("b", 50), ("c", 49)))
    numbers = " ".join(str(k) for k in range(60))
    hot = [" ".join(long.split()[:3] + [f"{w}{chr(97 + k)}" for w in WORDS[:19] * 3]) for k in range(6)]  # fill the leaf of long
    texts = ["one\n" + long, "two\n" + long + "\n" + short, "three\n" + short + "\n" + other, other, "four\n" + numbers, numbers.replace("7", "8"), *hot]
    got = {r.doc_id: r.text for r in linededup.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == dict(enumerate(texts)) | {1: "two\n" + short, 3: ""}


def test_decontam(spark):
    item = "the quick brown fox jumps over the lazy dog near the old river bank at dawn"
    edited = item.replace("brown", "red").replace("old", "very old")
    rows = [(0, f"start of it {item} and the end"), (1, f"x y z {edited.upper()}!"), (2, "nothing of the kind in here at all"), (3, None), (4, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(7, item), (8, None), (9, "")], "item_id long, text string")
    got = {r.doc_id: [x.item_id for x in r.h] for r in d.select("doc_id", decontam.found(d, b).alias("h")).collect()}
    assert got == {0: [7], 1: [7], 2: [], 3: [], 4: []}


def full_alignment(a, b):
    h = [0] * (len(b) + 1)
    best = 0
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, h[j] + (2 if x == y else -1), h[j + 1] - 1, new[j] - 1))
        h, best = new, max(best, *new)
    return best


def test_decontam_against_plain_python(spark):
    """Copies with every fifth word or so edited; items below a seed, unspaced scripts, second passages, a very long text."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randrange(8, 30))] for _ in range(30)]
    noise = lambda n: [rng.choice(vocabulary) for _ in range(n)]

    def edit(words):
        return [y for x in words for y in rng.choices([[x], [rng.choice(vocabulary)], [], [x, rng.choice(vocabulary)]], [80, 10, 5, 5])[0]]

    texts = [noise(40) + edit(item) + noise(30) for item in items for _ in range(3)] + [noise(60) for _ in range(30)]
    texts.append(noise(100_000) + items[0] + noise(100_000) + items[0] + noise(10))
    d = spark.createDataFrame([(i, " ".join(t), 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, item_id long, score string")
    b = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.x.item_id): r.x.score for r in d.filter("doc_id < 120").select("doc_id", F.explode(decontam.found(d, b)).alias("x")).collect()}
    want = {(i, k): s for i, t in enumerate(texts[:120]) for k, item in enumerate(items) if (s := full_alignment(item, t) / (2 * len(item))) >= decontam.CONTAMINATED}
    assert set(got) <= set(want) and all(got[k] <= want[k] for k in got)
    assert len(want) >= 85 and len(got) >= 0.97 * len(want)
    last = d.filter("doc_id = 120").select(F.explode(decontam.found(d, b)).alias("x")).filter("x.item_id = 0").collect()
    assert [(r.x.score, " ".join(texts[120]).encode()[r.x.start : r.x.end].decode()) for r in last] == [(1.0, " ".join(items[0]))] * 2


def test_decontam_of_short_and_unspaced_items(spark):
    rows = [(0, "We saw a Blue whale, twice."), (1, "blue and whale"), (2, "昨天有人问：长江的长度是多少公里？没有人回答。"), (3, "yes"), (4, "ราคาเท่าไรครับวันนี้")]
    rows += [(i, "they said yes to it") for i in range(5, 30)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(0, "blue whale"), (1, "长江的长度是多少公里"), (2, "yes"), (3, "ราคาเท่าไร"), (3, "ราคาเท่าไร"), (4, None)], "item_id long, text string")
    got = d.select("doc_id", F.explode(decontam.found(d, b)).alias("x")).collect()
    assert sorted((r.doc_id, r.x.item_id) for r in got) == [(0, 0), (2, 1), (3, 2), (4, 3), (4, 3)]
    assert all(r.x.score == 1 for r in got)
    text = dict(rows)
    assert {text[r.doc_id].encode()[r.x.start : r.x.end].decode() for r in got} == {"Blue whale", "长江的长度是多少公里", "yes", "ราคาเท่าไร"}
    assert d.filter("doc_id < 0").select(F.explode(decontam.found(d.filter("doc_id < 0"), b))).count() == 0
    assert d.select(F.explode(decontam.found(d, b.filter("item_id > 9")))).count() == 0


def test_alignment():
    def slow(a, b):
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        return h.max()

    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 4, 12), rng.integers(0, 4, 20)
        assert decontam.align(a, b)[0] == slow(a, b)


def test_segments():
    rng = np.random.default_rng(2)
    for k in range(150):
        x = np.round(rng.normal(-0.3, 1, 1 + k % 40), 2) if k % 2 else rng.integers(-2, 3, 1 + k % 40).astype(float)
        whole = lambda a, b: (a, b, x[a:b].sum())
        want, todo = [], [(0, len(x))]
        while todo:  # the best segment, then the best ones on its either side
            a, b = todo.pop()
            spans = [whole(i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
            best = max(spans, key=lambda t: (round(t[2], 9), t[0] - t[1]), default=None)
            if best and best[2] > 1e-9:
                want.append(best)
                todo += [(a, best[0]), (best[1], b)]
        got = toxicity.segments(x)
        assert math.isclose(sum(t for *_, t in got), sum(t for *_, t in want), abs_tol=1e-6) and all(math.isclose(x[a:b].sum(), t, abs_tol=1e-9) for a, b, t in got)
        assert all(b <= c for (_, b, _), (c, _, _) in zip(got, got[1:]))
    assert toxicity.segments(np.zeros(0)) == [] and toxicity.segments(np.array([1.0] * 10)) == [(0, 10, 10.0)]


def test_classifiers(spark):
    good, bad = "we like a calm and long sentence here.", "you idiot moron, worthless scum"
    d = spark.createDataFrame([(i, (bad if i % 3 == 0 else good) + " " + WORDS[i % 20]) for i in range(300)] + [(900, None), (901, "")], "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(200)] + [(250, None, None)], "doc_id long, quality int, toxic int")
    m = toxicity.fit(d, lab)
    got = {r.doc_id: r.x.score for r in d.select("doc_id", toxicity.score(m, spark, F.col("text")).alias("x")).collect()}
    assert got[297] > 0.7 > got[298] and got[900] == got[901] <= min(got.values())
    q = quality.fit(d, lab)
    s = d.select("doc_id", q.score(quality.stats_of(F.col("text"))).alias("s")).filter("doc_id in (297, 298)").orderBy("doc_id").collect()
    assert s[0].s < 0.3 < s[1].s
    none = lab.limit(0)
    assert toxicity.fit(d, none) is None and quality.fit(d, none).bias == 0.0


def test_language(spark):
    d = spark.createDataFrame([(i, "the man and the dog walk there", "en") for i in range(5)] + [(i, "der hund und das haus sind schön", "de") for i in range(5, 10)] + [(10, "123 !?", "en"), (11, None, None), (12, "das haus und der mann", None)], "doc_id long, text string, lang string")
    m = langid.fit(d)
    got = {r.doc_id: r.x.lang_pred for r in d.select("doc_id", langid.identify(m, spark, F.col("text")).alias("x")).collect()}
    assert got[0] == "en" and got[12] == "de" and got[10] == got[11] == "und"
    assert langid.fit(d.limit(0)) is None
    code = langid.codewords(12)
    assert len({tuple(c) for c in code}) == 12


def test_fingerprints(spark, docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda x: (x[0] is None, -(x[0] or 0)))
    got = {r.doc_id: r for r in fingerprint.neighbours(docs).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        e = fingerprint.edited(t, rows[(k + 1) % len(rows)][1])
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        a, b = (fingerprint.digests([x])[0].tolist() for x in (t, e))
        want = len({*a} & {*b}) / len({*a} | {*b}) if a or b else 1.0
        assert math.isclose(got[i].near_edited, want)
    assert fingerprint.neighbours(docs.limit(0)).count() == 0


def plain_ppm(train, text):
    """log10 probability of a text by the same model in plain Python: method D, exclusion, contexts from the longest."""
    spelled = lambda t: [*[ppm.START] * ppm.ORDER, *b" ".join(w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()), ppm.STOP]
    counts = {}
    for t in train:
        b = spelled(t)
        for i in range(ppm.ORDER, len(b)):
            for k in range(ppm.ORDER + 1):
                at = counts.setdefault(tuple(b[i - k : i]), {})
                at[b[i]] = at.get(b[i], 0) + 1
    out, b = 0.0, spelled(text)
    for i in range(ppm.ORDER, len(b)):
        gone = set()
        for k in range(ppm.ORDER, -1, -1):
            at = {x: n for x, n in counts.get(tuple(b[i - k : i]), {}).items() if x not in gone}
            if b[i] in at:
                out += math.log10((at[b[i]] - 0.5) / sum(at.values()))
                break
            if at:
                out += math.log10(len(at) / (2 * sum(at.values())))
                gone |= set(at)
        else:
            out -= math.log10(256 - len(gone))
    return out


def test_ppm_against_plain_python(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 20))) for _ in range(40)] + [None, "", " \n", "Alpha\n BETA é", "alpha beta é", "alpha " * 3000]
    texts += texts[:3]
    rows = [(i if i != 5 else None, t, 1.0) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string, score double")
    held = F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    train = [t for i, t, _ in rows if i is None or i % 3]
    words = lambda t: [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()]
    seen = {}
    for t in train:
        for w in [*words(t), None]:
            seen[w] = seen.get(w, 0) + 1
    n, v = sum(seen.values()), len(seen)
    got = {r.doc_id: r for r in ppm.score(d.repartition(7), held).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        tokens, r = [*words(t), None], got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in seen for w in tokens), n) and r.held_out == bool(i is not None and i % 3 == 0)
        assert math.isclose(r.base_score, sum(math.log10((seen.get(w, 0) + 1) / (n + v + 1)) for w in tokens), rel_tol=1e-9)
        assert math.isclose(r.score, plain_ppm(train, t), rel_tol=1e-6, abs_tol=1e-5), (i, t)
    assert ppm.score(d.limit(0), held).count() == 0
    lone = ppm.score(d.filter("doc_id = 3"), F.lit(True)).first()  # nothing to learn from
    assert lone.train_tokens == 0 and math.isclose(lone.score, -math.log10(256) * (len(texts[3]) + 1), rel_tol=1e-6)


def test_warc(spark, tmp_path):
    pages = spark.createDataFrame([(3, "http://a/ b", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "http://c", None), (4, "u", "WARC/1.1\r\nWARC-Type: x"), (5, "u", "")], "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc.write(pages, path)
    got = {r.record_id: r for r in warc.read(spark, path, True).collect()}
    name = lambda k: f"<{warc.URN}{k}>"
    assert len(got) == 5 and got[name(3)].type == "revisit" and got[name(3)].refers_to == name(1) and got[name(3)].payload_bytes == 9
    assert bytes(got[name(4)].payload) == b"WARC/1.1\r\nWARC-Type: x" and got[name(5)].refers_to == name(2) and got[name(3)].uri == "http://a/%20b"


def test_salvage():
    rec = lambda k, body: (f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <{k}>\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
    a, b, c = rec("a", b"one"), rec("b", b"two"), rec("c", b"three")
    ids = lambda data: [r.get("record_id") or r["type"] for r in warc.salvage(data)]
    assert ids(a + b + c) == ["<a>", "<b>", "<c>"]
    assert ids(a + b.replace(b"Length: 3", b"Length: 9") + c) == ["<a>", "gap", "<c>"]
    assert ids(gzip.compress(a) + gzip.compress(b)[:-9] + b"junk" + gzip.compress(c)) == ["<a>", "gap", "<c>"]
    assert ids(b"noise" + a + b[:-6]) == ["gap", "<a>", "gap"]
    data = b"noise" + a + b[:-6]
    assert sum(r["length"] for r in warc.salvage(data)) == len(data)
    assert list(warc.salvage(b"")) == []


def record(name, body, digest=None):
    digest = digest if digest is not None else "sha1:" + warc.base64.b32encode(hashlib.sha1(body).digest()).decode()
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <{name}>\r\n" + (f"WARC-Payload-Digest: {digest}\r\n" if digest else "") + f"Content-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def names(data):
    return [r.get("record_id", "gap") for r in warc.salvage(data)]


def test_salvage_inside_a_gzip_member():
    rng = random.Random(5)
    one, two, three = (record(k, bytes(rng.randrange(256) for _ in range(40_000))) for k in "abc")
    bad = two.replace(two[-40:-30], b"0123456789")
    member = gzip.compress(one + bad + three)
    rows = list(warc.salvage(member + gzip.compress(two)))
    assert [r.get("record_id", "gap") for r in rows] == ["<a>", "gap", "<c>", "<b>"]
    assert {(r["offset"], r["length"]) for r in rows[:3]} == {(0, len(member))}
    assert [(r["inner_offset"], r["inner_length"]) for r in rows[:3]] == [(0, len(one)), (len(one), len(bad)), (len(one) + len(bad), len(three))]
    whole = gzip.compress(one + two + three)
    assert names(whole[: len(whole) * 5 // 6] + gzip.compress(two)) == ["<a>", "<b>", "gap", "<b>"]  # cut off in the third
    spoilt = whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:]
    assert names(spoilt + gzip.compress(three)) == ["<a>", "<b>", "<c>", "gap", "<c>"]  # the checksum is wrong, the digests aren't
    bare = gzip.compress(record("n", b"no digest", ""))
    assert names(bare) == ["<n>"] and names(bare[:-8] + b"12345678") == ["gap"]
    assert names(gzip.compress(b"")) == [] and names(gzip.compress(b"no record")) == ["gap"]


def test_digests_of_several_algorithms():
    body = b"some payload"
    b32 = lambda d: warc.base64.b32encode(d).decode()
    right = ["sha256:" + hashlib.sha256(body).hexdigest(), "sha-256:" + b32(hashlib.sha256(body).digest()), "md5:" + hashlib.md5(body).hexdigest().upper(), "SHA1:" + b32(hashlib.sha1(body).digest()).lower(), "blake3:00", ""]
    assert all(names(record("r", body, d)) == ["<r>"] for d in right)
    assert all(names(record("r", body + b".", d)) == ["gap"] for d in right[:4])


def test_many_members_take_time_in_proportion():
    data = b"".join(gzip.compress(record(str(k), b"x" * 900), 1) for k in range(16_000))
    start = time.process_time()
    assert len(names(data)) == 16_000
    assert time.process_time() - start < 4


def test_damaged_files_through_read(spark, tmp_path):
    parts = [record(str(k), b"y" * 50) for k in range(4)]
    (tmp_path / "plain.warc").write_bytes(parts[0] + parts[1].replace(b"yy", b"yz", 1) + b"junk" + parts[2])
    whole = gzip.compress(parts[3])
    (tmp_path / "cut.warc.gz").write_bytes(whole + gzip.compress(parts[0])[:-20] + whole)
    (tmp_path / "empty.warc").write_bytes(b"")
    got = {}
    for r in warc.read(spark, str(tmp_path)).orderBy("file", "offset").collect():
        got.setdefault(r.file.rsplit("/", 1)[1], []).append(r.record_id or r.type)
    assert got == {"plain.warc": ["<0>", "gap", "<2>"], "cut.warc.gz": ["<3>", "gap", "<3>"]}


def plain_statistics(text):
    b = (text or "").encode()
    fold = lambda x: bytes(c + 32 if 65 <= c <= 90 else c for c in x)
    words = [x for x in re.split(rb"[\x20\x09-\x0D]+", b) if x]
    count = lambda test: sum(1 for c in b if test(c))
    letters = count(lambda c: 65 <= c <= 90 or 97 <= c <= 122 or c >= 128)
    lines = [fold(x) for x in b.split(b"\n") if x]
    pairs = list(zip([*map(fold, words)], [*map(fold, words)][1:])) or ([(words[0],)] if words else [])
    w, size, folded = max(len(words), 1), max(len(b), 1), [fold(x) for x in words]
    return {
        "log_words": math.log1p(len(words)), "word_length": sum(map(len, words)) / w, "upper": count(lambda c: 65 <= c <= 90) / max(letters, 1), "symbols": count(lambda c: chr(c) in "#$%&*+/<=>@[\\]^_`{|}~") / w,
        "bangs": count(lambda c: chr(c) in "!?") / w, "digits": count(lambda c: 48 <= c <= 57) / size, "non_ascii": count(lambda c: c >= 128) / size, "stops": count(lambda c: chr(c) in ".,;:") / w,
        "distinct_words": len({*folded}) / w, "repeats": sum(x == y for x, y in zip(folded, folded[1:])) / w, "distinct_pairs": len({*pairs}) / max(len(pairs), 1), "line_words": len(words) / max(len(lines), 1),
        "distinct_lines": len({*lines}) / max(len(lines), 1), "letters": letters / size, "longest_word": math.log1p(max(map(len, words), default=0)),
    }


def test_quality_against_plain_python(spark):
    """Statistics and the compiled column expression, on nulls, empty, repeated and very long texts; columns with clashing names."""
    rng = random.Random(8)
    line = lambda: " ".join(rng.choice([w, w.upper(), w + rng.choice(".,;:!?#"), str(rng.randrange(99)), "é" + w]) for w in rng.choices(WORDS, k=rng.randrange(1, 9)))
    texts = [None, "", " \n\t", "one", "\n".join(line() for _ in range(20_000))] + ["\n".join(line() for _ in range(rng.randrange(1, 5))) for _ in range(150)]
    texts += texts[10:20]
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, s long, stats string")
    lab = spark.createDataFrame([(i, int(len(t or "") % 3 > 0)) for i, t in enumerate(texts)], "doc_id long, quality int")
    m = quality.fit(d, lab)
    assert m.rules
    for r in d.select("doc_id", quality.stats_of(F.col("text")).alias("v")).select("doc_id", "v", m.score(F.col("v")).alias("y")).collect():
        want = plain_statistics(texts[r.doc_id])
        assert set(want) == set(quality.STATS) and all(math.isclose(r.v[k], x, abs_tol=1e-12) for k, x in want.items()), texts[r.doc_id]
        z = m.bias + sum(w for rule, w in zip(m.rules, m.weights) if all((r.v[quality.STATS[k]] <= t) == at_most for k, at_most, t in rule))
        assert math.isclose(r.y, 1 / (1 + math.exp(-z)))


def test_quality_learns_from_few_labels(spark):
    d = spark.createDataFrame([(i, "!!! ??? # # #" if i % 2 else "a calm line of plain words") for i in range(14)], "doc_id long, text string")
    for n in (6, 12):
        m = quality.fit(d, spark.createDataFrame([(i, 1 - i % 2) for i in range(n)], "doc_id long, quality int"))
        got = {r.doc_id: r.y for r in d.select("doc_id", m.score(quality.stats_of(F.col("text"))).alias("y")).collect()}
        assert got[13] < 0.5 < got[12]


def plain_langid(rows, texts):
    """(language, its share) of each text by the rule in plain Python, from rows (text, language)."""

    def trigrams(t):
        b = [c | 32 if 65 <= c <= 90 or 97 <= c <= 122 else c if c >= 128 else 32 for c in (t or "").encode()]
        for x, y, z in zip(b, b[1:], b[2:]):
            if y != 32 and (x != 32 or z != 32):
                h = (x * 0x9E3779B1 + y * 0x85EBCA6B + z * 0xC2B2AE35) % 2**32
                yield ((h ^ h >> 15) * 0x2C1B3C6D % 2**32) >> 16

    count = {}
    for t, lang in rows:
        if t is not None and lang is not None:
            for g in trigrams(t):
                at = count.setdefault(lang, {})
                at[g] = at.get(g, 0) + 1
    langs = sorted(count)
    total = {x: sum(c.values()) + 0.05 * langid.BUCKETS for x, c in count.items()}
    prob = lambda lang, g: (count[lang].get(g, 0) + 0.05) / total[lang]
    code, known = langid.codewords(len(langs)), {g for c in count.values() for g in c}
    sides = [[[x for x, c in zip(langs, column) if c * s > 0] for s in (1, -1)] for column in code.T]

    def sides_of(b, g):
        return [sum(prob(x, g) for x in side) / len(side) for side in sides[b]]

    def weight(b, g):
        p, n = sides_of(b, g)
        return math.log(p / n)

    trust = []
    for b in range(len(sides)):
        each = lambda g: (lambda p, n: (p - n) * math.log(p / n))(*sides_of(b, g))  # noqa: B023, E731
        trust.append(math.sqrt(sum(map(each, known)) + (langid.BUCKETS - len(known)) * each(-1)))
    trust = [x / sum(trust) * min(len(trust), 8) for x in trust]
    for t in texts:
        g = list(trigrams(t))
        margin = [sum(weight(b, x) for x in g) / max(len(g), 1) * min(len(g), langid.CERTAIN) for b in range(len(sides))]
        loss = [sum(u * math.log1p(math.exp(-m * c)) for u, m, c in zip(trust, margin, word)) for word in code]
        share = [math.exp(min(loss) - x) for x in loss]
        best = max(range(len(langs)), key=lambda i: share[i])
        yield langs[best], share[best] / sum(share)


@pytest.mark.parametrize("n", [2, 4, 7])
def test_language_against_plain_python(spark, n):
    rng = random.Random(n)
    alphabets = [rng.choices("abcdefghijklmnopqrstuvwxyzäéøßж漢", k=9) for _ in range(n)]
    say = lambda k, m: " ".join("".join(rng.choices(alphabets[k], k=rng.randrange(1, 7))) for _ in range(m))
    rows = [(say(i % n, rng.randrange(1, 30)), f"l{i % n}" if i % 9 else None) for i in range(60)] + [(None, "l0"), ("", "l1"), ("A b. c", None), (say(0, 30_000), None), ("12 34", None)]
    rows += rows[:5]
    d = spark.createDataFrame([(i, *r, 0.5) for i, r in enumerate(rows)], "doc_id long, text string, lang string, score double")
    m = langid.fit(d)
    got = {r.doc_id: r.x for r in d.select("doc_id", langid.identify(m, spark, F.col("text")).alias("x")).collect()}
    for i, (lang, share) in enumerate(plain_langid(rows, [t for t, _ in rows])):
        if any(c.isalpha() for c in rows[i][0] or ""):
            assert math.isclose(got[i].score, share, rel_tol=1e-4) and (got[i].lang_pred == lang or share < 0.51), rows[i]
        else:
            assert got[i].lang_pred == "und" and got[i].score == 0


def test_fingerprints_of_equal_texts_and_of_the_next(spark, docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda x: (x[0] is None, -(x[0] or 0)))
    got = {r.doc_id: r for r in fingerprint.neighbours(docs.repartition(5)).collect()}
    prints = {}
    for k, (i, t) in enumerate(rows):
        a, b = (set(fingerprint.digests([x])[0].tolist()) for x in (t, rows[(k + 1) % len(rows)][1]))
        assert math.isclose(got[i].near_next, len(a & b) / len(a | b) if a or b else 1.0)
        assert prints.setdefault(t, got[i].fingerprint) == got[i].fingerprint
    assert len({*prints.values()}) > 0.9 * len(prints)


def test_pipeline_against_plain_python(spark, tmp_path):
    """All five stages: rejected texts, recurring lines, groups of copies, benchmark passages, then the mix by its SQL."""
    import duckdb

    import corpus_pipeline
    from wirequery.llm.queries import OP10_SQL

    rng = random.Random(12)
    say = lambda n: " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))
    base = [say(40) for _ in range(40)]
    item, common = say(20), "this very line stands in many texts of the corpus"
    texts = base + base[:6] + [t + " and one more" for t in base[6:12]] + [f"{say(30)} {item} {say(10)}" for _ in range(3)] + [f"{say(30)}\n{common}\n{say(5)}" for _ in range(7)]
    texts += [None, "", "12 34 !?"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, kinds).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    keep = [(i, t) for i, t, *_ in rows if any(c.isalpha() for c in t or "")]
    drop = linededup_plain(keep)
    keep = [(i, "\n".join(l for l in t.split("\n") if l not in drop.get(t, ()))) for i, t in keep]
    assert sum(map(len, drop.values())) == 6
    each = []
    for i, t in keep:  # here every group links with its least member
        if not any(100 * len(shingles(t) & shingles(x)) >= 75 * len(shingles(t) | shingles(x)) for _, x in each):
            each.append((i, t))
    assert len(keep) - len(each) == 12
    clean = [(i, t) for i, t in each if item not in t]
    assert len(each) - len(clean) == 3
    of = {r[0]: r for r in rows}
    documents = spark.createDataFrame([(i, t, "en", of[i][3], len(t)) for i, t in clean], kinds).toPandas()  # noqa: F841
    with duckdb.connect() as c:
        c.register("documents", documents)
        want = sorted(c.sql(f"select doc_id, text, n_chars, mix_rate, mix_copy, mix_order from ({OP10_SQL})").fetchall())
    got = corpus_pipeline.run(spark, str(tmp_path)).selectExpr("doc_id", "text", "n_chars", "round(mix_rate, 9)", "mix_copy", "mix_order").collect()
    assert len(want) > 30 and sorted(map(tuple, got)) == want


def test_pipeline_of_no_documents(spark, tmp_path):
    import corpus_pipeline

    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], kinds).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "an item of the test set")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
