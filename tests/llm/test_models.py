"""Toxicity and personal data: held-out accuracy, brute force, edge cases; decontamination by planted copies."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalith.llm import decontamination, pii, toxicity

SF = "/root/testdata/sf0.01"
EDGES = [
    (5001, None),
    (5002, ""),
    (5003, "é" * 50 + " a.b@c-d.example.org +44 20 7946 0958 x 10.20.30.40 y 4111 1111 1111 1111"),
    (5004, "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.004 a@b a@b.c@d.e @x.y"),
    (5005, "9" * 50_000 + " " + "a" * 50_000),
    (5006, "+1 2345-678.90() +12 +123456789012345678 1234-5678  9012"),
    (5006, "repeat"),
    (None, "mail me: q@w.er"),
]


def edges(spark):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in EDGES], "doc_id long, text string, found string, score int")


def brute_spans(text):
    """The patterns as they are written, on the text itself."""
    text, found = text or "", []
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    ]
    for k, pattern in enumerate(patterns):
        if k == 0 and "@" not in text or k == 1 and len(text) > 50_000:
            continue
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            keep = (
                True,
                all(int(p) <= 255 for p in m[0].split(".")) if k == 1 else True,
                12 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                9 <= len(digits) <= 15,
            )[k]
            if keep:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def test_pii_base_is_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pii, "EPOCHS", 2)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(edges(spark).select("doc_id", "text"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = pii.op10_pii(spark, str(tmp_path)).collect()
    want = []
    for r in docs.collect():
        spans = brute_spans(r.text)
        named = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        counts = [sum(k == i for _, k, _ in spans) for i in range(4)]
        want.append(str((r.doc_id, counts, hashlib.sha256(",".join(named).encode()).hexdigest())))
    assert sorted(str((r.doc_id, [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256)) for r in got) == sorted(want)


@pytest.fixture(scope="module")
def tagger(spark):
    """A network trained on a third of the documents, and the texts of another third."""
    texts = {k: [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(f"doc_id % 3 = {k}").orderBy("doc_id").collect()] for k in (0, 1)}
    cut = [region for t in texts[0] for region in pii.drawn_regions(t)]
    return pii.fit(*pii.training_windows(cut, np.random.default_rng(9))), texts[1]


def test_pii_network_on_held_out_documents(tagger):
    net, held = tagger
    tagged = pii.tagged_spans(held, net)
    base = [pii.code_points(t.encode(), pii.pattern_spans(t.encode())) for t in held]
    found = sum(len(set(a) & set(b)) for a, b in zip(tagged, base, strict=True))
    assert found >= 0.9 * sum(map(len, base))
    clean = [t for t in held if not pii.pattern_spans(t.encode(), check=False)]
    added = [s for s in pii.find_all([t.encode() for t in clean], net) if s]
    assert len(added) <= 0.01 * len(clean)
    kinds = {k for s in pii.find_all([b"please write to john.doe (at) mail.example.com now"], net) for _, k, _, base in s if not base}
    assert kinds == {0}
    # a match that its pattern drops (a check digit that fails, a part above 255) is no personal data
    for text, spans in zip(held, pii.find_all([t.encode() for t in held], net), strict=True):
        dropped = [(m.start(), m.end()) for m in re.finditer(r"[0-9](?:[\x20-]?[0-9])+|[0-9]+(?:\.[0-9]+){3}", text)]
        assert not any(not own and (a, b) in dropped for a, _, b, own in spans)


def planted(held, made, rng):
    host = held[rng.integers(len(held))]
    at = int(rng.integers(max(1, len(host) - 200)))
    before, after = (re.sub("[0-9@]", "", host[lo : lo + 80]) for lo in (at, at + 80))
    return f"{before} {made} {after}", len(before) + 1


def test_pii_network_finds_what_patterns_miss(tagger):
    """Unseen values of each kind in words of held-out documents, of which no pattern finds any part."""
    net, held = tagger
    rng = np.random.default_rng(77)
    missed = {k: [0, 0, 0] for k in range(4)}
    for n in range(800):
        kind = n % 4
        made = pii.spelled(kind, rng)
        text, at = planted(held, made, rng)
        spans = pii.find_all([text.encode()], net)[0]
        mine = [s for s in spans if s[0] < at + len(made) and at < s[2]]
        if not any(s[3] for s in mine):
            missed[kind][0] += 1
            missed[kind][1] += any(s[:3] == (at, kind, at + len(made)) for s in mine)
            missed[kind][2] += any(s[1] == kind for s in mine)
    total, exact, overlapping = map(sum, zip(*missed.values(), strict=True))
    assert min(n for n, _, _ in missed.values()) >= 100
    assert exact >= 0.85 * total and overlapping >= 0.93 * total
    assert all(part >= 0.85 * n for n, _, part in missed.values())
    marked = sum(bool(pii.find_all([planted(held, pii.lookalike(rng), rng)[0].encode()], net)[0]) for _ in range(400))
    assert marked <= 8


@pytest.mark.parametrize("at_once", [1, 7])
def test_pii_windows_are_reconciled_alike(tagger, monkeypatch, at_once):
    net, held = tagger
    rng = np.random.default_rng(5)
    texts = [planted(held, " ".join(pii.spelled(int(k), rng) for k in rng.integers(0, 4, 6)), rng)[0] for _ in range(60)]
    want = pii.tagged_spans(texts, net)
    assert sum(map(len, want)) > 100
    monkeypatch.setattr(pii, "TAGGED", at_once)
    assert pii.tagged_spans(texts, net) == want


def test_pii_window_without_tags_speaks_in_any_chunk(monkeypatch):
    """A later window without tags overrules the tags of an earlier one where its place is deeper."""

    class Stub:
        def decode(self, x):
            tags = np.zeros(x.shape, np.int8)
            for row in range(len(x)):
                if x[row, 0] == pii.classes_of("q")[0]:  # the first window alone
                    tags[row, 40:56] = 4
                    tags[row, 40] = 3
            return tags

    text = "q" + "1" * 103
    got = []
    for at_once in (1, 2, 1024):
        monkeypatch.setattr(pii, "TAGGED", at_once)
        got.append(pii.tagged_spans([text], Stub()))
    assert got[0] == got[1] == got[2] and got[0] == [[(40, 1, 52)]]


def test_pii_regions_are_drawn_from_any_place():
    texts = [f"{k} " + "".join(str(n % 10) for n in range(4000)) for k in range(200)]
    drawn = [pii.drawn_regions(t)[0] for t in texts]
    assert max(map(len, drawn)) <= pii.REGION and len({t.find(d) // 1000 for t, d in zip(texts, drawn, strict=True)}) >= 1
    assert sum(not t.startswith(d) for t, d in zip(texts, drawn, strict=True)) >= 150


def test_pii_gradients_are_differences():
    rng = np.random.default_rng(0)
    net = pii.Network.fresh(rng)
    net.w = {k: v.astype(np.float64) + 0.1 * rng.standard_normal(v.shape) for k, v in net.w.items()}
    x, y = rng.integers(0, pii.CLASSES, (3, 7)), rng.integers(0, pii.TAGS, (3, 7))
    _, g = net.gradients(x, y)
    for name, v in net.w.items():
        at = (x[0, 3] if name[0] == "x" else 1, *([2] if v.ndim > 1 else []))
        before, losses = v[at], []
        for step in (1e-2, -1e-2):
            v[at] = before + step
            losses.append(net.gradients(x, y)[0])
        v[at] = before
        assert abs((losses[0] - losses[1]) / 2e-2 - g[name][at]) < 2e-3, name


def test_windows_cover_every_trigger():
    text = "x" * 100 + "12 " * 200 + "y" * 300 + "a(at)b" + "z" * 200 + "me [AT] here Dot there"
    places = pii.window_places(text)
    marks = [*pii._DIGITS.finditer(text), *pii._SPELLED.finditer(text)]
    assert len(marks) == 203
    for m in marks:
        assert any(lo <= m.start() and m.end() <= hi for lo, hi in places)
    assert all(hi - lo <= pii.WIDTH for lo, hi in places)


def test_crf_decodes_the_best_path():
    rng = np.random.default_rng(0)
    net = pii.Network.fresh(rng)
    net.w["next"] = rng.standard_normal((pii.TAGS, pii.TAGS)).astype(np.float32)
    x = rng.integers(0, pii.CLASSES, (1, 4))
    e, tags = net.emissions(x)[0], net.decode(x)[0]
    score = lambda p: sum(e[t, k] for t, k in enumerate(p)) + sum(net.w["next"][a, b] for a, b in zip(p, p[1:], strict=False))
    from itertools import product

    assert tuple(tags) == max(product(range(pii.TAGS), repeat=4), key=score)


def test_kernel_is_brute_force():
    from itertools import combinations

    def features(word):
        out = {}
        for p in combinations(range(len(word)), 3):
            out.setdefault("".join(word[i] for i in p), []).append(toxicity.DECAY ** (p[-1] - p[0] + 1))
        return {k: sum(v) for k, v in out.items()}

    a, b = features("idiotic"), features("idixot")
    want = sum(v * b.get(k, 0) for k, v in a.items()) / np.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    got = toxicity.kernel_sums(["idiotic"], toxicity.triple_table(["idixot"]))[0, 0]
    assert abs(got - want) < 1e-4


def test_toxicity_held_out(spark, tmp_path):
    got = toxicity.op8_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    toxic = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.01 * len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.select("doc_id", "held_out").limit(500).collect())


def brute_score(model, text):
    """The score by its definition: each word's kernel sum over all its subsequences, one by one."""
    from itertools import combinations

    def margin(word):
        code = [26 + ord(c) % (toxicity.LETTERS - 28) if ord(c) >= 0x3000 else int(toxicity.letter_codes()[ord(c)]) for c in toxicity.read_as_letters(word)]
        features = {}
        for p in combinations(range(len(code)), 3):
            if min(code[i] for i in p) >= 0:
                key = (code[p[0]] * toxicity.LETTERS + code[p[1]]) * toxicity.LETTERS + code[p[2]]
                features[key] = features.get(key, 0) + toxicity.DECAY ** (p[2] - p[0] + 1)
        norm = max(1e-9, sum(v * v for v in features.values())) ** 0.5
        return sum(v * model.weights[k, 0] for k, v in features.items()) / norm + model.bias

    found = sorted((max(map(margin, words)) for words in toxicity.sentences(text)), reverse=True)
    top = [min(max(m, -1.5), 2.0) for m in [*found, -1.5, -1.5, -1.5][:3]]
    x = np.array([*top, np.log1p(sum(m > 0 for m in found))])
    return 1 / (1 + np.exp(-np.clip(x @ model.curve[:-1] + model.curve[-1], -30, 30)))


def test_toxicity_is_brute_force(spark):
    """Scores of whole texts, each word's kernel taken by definition."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = toxicity.train_on(docs, spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"))
    got = {r.doc_id: r for r in toxicity.op8_toxicity(spark, folder).collect()}
    texts = {r.doc_id: r.text for r in docs.where("length(text) < 1500").orderBy("doc_id").collect()}
    assert len(texts) > 100
    for key, text in list(texts.items())[:150]:
        want = brute_score(model, text)
        assert abs(got[key].score - want) < 1e-3, key
        assert got[key].predicted == int(got[key].score >= 0.7)


def test_toxicity_edges(spark, tmp_path):
    train = [(i, "you are an idiot and a clown. nice day" if i % 4 == 0 else "you are an artist and a friend. nice day") for i in range(80)]
    rows = [(i, t) for i, t in EDGES] + train + [(900, "what an i.d.i.o.t he is"), (901, "i d i o t here"), (902, "a fine day")]
    spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, score int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in train] + [(None, 1), (900, None)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in toxicity.op8_toxicity(spark, str(tmp_path)).collect()}
    assert len(got) == len(set(i for i, _ in rows))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert min(got[900].score, got[901].score) > max(got[902].score, got[5002].score)


def test_toxicity_without_labels(spark, tmp_path):
    edges(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.score for r in toxicity.op8_toxicity(spark, str(tmp_path)).collect()} == {0.0}


def edit(words, rng, share):
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < share / 3 else [w, "inserted"] if x < 2 * share / 3 else ["other"] if x < share else [w]
    return out


@pytest.mark.parametrize("block_words", [2_000_000, 50])
def test_contamination_finds_planted_copies(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block_words)
    rng = np.random.default_rng(2)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r.item_id: r.text for r in items.collect()}
    filler = ["w%d" % i for i in range(200)]
    rows, want = [], set()
    for n, (key, text) in enumerate(texts.items()):
        around = lambda: " ".join(rng.choice(filler, 60))
        rows.append((n, f"{around()} {text.upper() if n % 2 else text} {around()}"))
        rows.append((1000 + n, f"{around()}\n{' '.join(edit(text.split(), rng, 0.12))} {around()}"))
        rows.append((2000 + n, around() + " " + around()))
        want |= {(n, key), (1000 + n, key)}
    rows += [(3000, None), (3001, ""), (3002, "short words"), (None, list(texts.values())[0])]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, score double")
    extra = spark.createDataFrame([(77, "short words"), (78, ""), (79, None), (None, "nothing at all")], "item_id long, text string")
    found = decontamination.find_contamination(docs, items.select("item_id", "text").union(extra)).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == want | {(3002, 77), (None, list(texts)[0])}
    assert all(r.score == 1.0 for r in found if r.doc_id is not None and r.doc_id < 1000)
    assert all(r.start_word in range(55, 66) for r in found if r.doc_id is not None and r.doc_id < 1000)


def brute_contamination(docs, items):
    """(document, item) for each pair that shares a run of three words and aligns over the whole document."""
    found = set()
    for d, text in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
        number = {w: k for k, w in enumerate(dict.fromkeys(words))}
        seeds = {tuple(words[k : k + 3]) for k in range(len(words) - 2)}
        for i, item in items:
            own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", item.lower())
            if not any(tuple(own[k : k + 3]) in seeds for k in range(len(own) - 2)):
                continue
            a, b = np.array([number.get(w, -1 - k) for k, w in enumerate(own)]), np.array([number[w] for w in words])
            if decontamination.align(a, b)[0] >= 0.5 * 2 * len(own):
                found.add((d, i))
    return found


def test_contamination_is_brute_force(spark):
    """All documents of the smallest tables and copies edited at random, from whole to beyond recognition."""
    rng = np.random.default_rng(6)
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    items += [(900 + k, "which of the following holds " + " ".join(f"q{k}x{j}" for j in range(12))) for k in range(20)]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 20000").collect()]
    for n in range(250):
        text = items[rng.integers(len(items))][1].split()
        docs.append((10_000 + n, " ".join([*rng.choice(text, 30), *edit(text, rng, float(rng.random() * 0.9)), *rng.choice(text, 30)])))
    docs.append((20_000, "which of the following holds is what is asked"))
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key} long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_contamination(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    want = brute_contamination(docs, items)
    assert got == want
    assert len(want) > 100
    assert {i for d, i in want if d >= 10_000} and not [d for d, _ in want if d == 20_000]


def test_short_items_mark_no_long_documents(spark):
    docs = spark.createDataFrame([(1, "yes"), (2, "well yes"), (3, "and yes it is so"), (4, "true or false it is asked here"), (5, "True or false?")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "yes"), (2, "true or false")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.find_contamination(docs, items).collect()} == {(1, 1), (2, 1), (5, 2)}


def test_alignment_is_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(30):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 15))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontamination.align(a, b)[0] == h.max()


@pytest.mark.parametrize("run", [pii.op10_pii, toxicity.op8_toxicity, decontamination.op5_decontamination])
def test_empty_tables(spark, tmp_path, run):
    edges(spark).where("doc_id = 99").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert run(spark, str(tmp_path)).collect() == []


def test_a_repeated_label_does_not_silence_the_others(spark, monkeypatch):
    """A text that would pass the bytes for training is left out, copies of a row count once, and the others are learnt."""
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 20_000)
    clean, bad = "the house stands by the river and the road", "you are a stupid worthless zzidiot"
    rows = [(k, f"{clean} {k}. {bad if k % 2 else clean} {k}.") for k in range(120)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, toxic int")
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    docs = plain.unionByName(plain.where("doc_id = 4").crossJoin(spark.range(700).select()))
    huge = plain.where("doc_id <> 6").unionByName(spark.createDataFrame([(6, clean * 2000)], "doc_id long, text string"))
    for table in (docs, huge):
        scored = toxicity.score_toxicity(plain, toxicity.train_on(table, labels)).collect()
        assert sum((r.score >= toxicity.THRESHOLD) == bool(r.doc_id % 2) for r in scored) >= 110
