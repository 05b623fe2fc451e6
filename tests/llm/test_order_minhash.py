"""Order MinHash: alignment against dynamic programming, classes against brute force."""

import itertools
import random

from cohortalloc.llm import order_minhash as O


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def edited(rnd, words, edits):
    out = list(words)
    for _ in range(edits):
        i = rnd.randrange(len(out))
        kind = rnd.randrange(3)
        if kind == 0:
            out.insert(i, f"n{rnd.randrange(10**6)}")
        elif kind == 1:
            out[i] = f"s{rnd.randrange(10**6)}"
        else:
            del out[i]
    return out


def test_banded_alignment(monkeypatch):
    rnd = random.Random(1)
    for _ in range(1500):
        monkeypatch.setattr(O, "BAND", rnd.choice([0, 1, 3, 40]))
        a = [rnd.randrange(rnd.choice([2, 9, 99])) for _ in range(rnd.randrange(1, 40))]
        b = edited(rnd, a, rnd.randrange(10)) if len(a) > 12 else [rnd.randrange(5) for _ in range(rnd.randrange(9))]
        d, most = plain_distance(a, b), rnd.randrange(15)
        assert O.distance(a, b, most) == (d if d <= most else None)


def corpus():
    """Groups of near copies, unrelated texts, texts that share a passage; every case by doc_id."""
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choices("abcdefgh", k=5))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rnd.randrange(60, 300))]
        texts += [base, base] + [edited(rnd, base, max(1, len(base) // 60)) for _ in range(4)]
    texts += [[word() for _ in range(rnd.randrange(20, 200))] for _ in range(60)]
    texts += [passage + [word() for _ in range(60)] for _ in range(20)]
    return [" ".join(t) for t in texts]


def test_classes_equal_brute_force_components(make_docs):
    texts = corpus()
    words = [O.words_of(t) for t in texts]
    label = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if O.alike(words[i], words[j]):
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    got = {r.doc_id: r.class_id for r in O.classes(make_docs(list(enumerate(texts)))).collect()}
    assert got == dict(enumerate(label))


def test_open_buckets_are_completed(make_docs):
    # b is near a and c, but a and c are not near each other: one class all the same
    rnd = random.Random(3)
    a = [f"w{i}" for i in range(200)]
    chain = [a]
    for k in range(6):
        step = list(chain[-1])
        for i in range(30 * k, 30 * k + 30):
            step[i] = f"x{k}{rnd.randrange(10**6)}"
        chain.append(step)
    rows = O.classes(make_docs(list(enumerate(" ".join(t) for t in chain)))).collect()
    assert {r.class_id for r in rows} == {0}


def test_large_open_buckets_are_completed(spark):
    # texts that share a passage, in one bucket of more than SMALL nodes; near copies of some, each text its own component
    rnd = random.Random(5)
    passage = [f"p{i}" for i in range(30)]
    texts = [passage + [f"w{rnd.randrange(300)}" for _ in range(rnd.randrange(15, 60))] for _ in range(60)]
    texts += [edited(rnd, t, O.allowed(len(t)) - 1) for t in texts[:30]] + [["only", "two"], ["alone"], ["a"] * 20, ["a"] * 22]
    nodes = [f"n{i:03}".encode() for i in range(len(texts))]
    linked = {(a, b) for (a, x), (b, y) in itertools.combinations(zip(nodes, texts), 2) if O.alike(x, y)}
    assert len(linked) >= 25 and len(texts) > O.SMALL
    members = [(1, node, len(t), len(texts)) for node, t in zip(nodes, texts)]
    members = spark.createDataFrame(members, "bucket long, node binary, n_words int, size long")
    labels = spark.createDataFrame([], "node binary, label binary")
    held = spark.createDataFrame([(n, " ".join(t)) for n, t in zip(nodes, texts)], "node binary, text string")
    found = O.links_across(members, labels, held).collect()
    assert {(bytes(r.a), bytes(r.b)) for r in found} == linked


def test_two_large_components_of_a_bucket_meet_without_all_pairs(spark):
    # 80 near copies of one text in two components of 40: all 1,600 pairs across would link
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    texts = [edited(rnd, base, 2) for _ in range(80)]
    nodes = [f"n{i:03}".encode() for i in range(len(texts))]
    members = spark.createDataFrame([(1, n, len(t), 80) for n, t in zip(nodes, texts)], "bucket long, node binary, n_words int, size long")
    labels = spark.createDataFrame([(n, nodes[i // 40 * 40]) for i, n in enumerate(nodes)], "node binary, label binary")
    held = spark.createDataFrame([(n, " ".join(t)) for n, t in zip(nodes, texts)], "node binary, text string")
    links = O.links_to_largest(O.open_members(members, labels), held)
    assert 1 <= links.count() <= 40
    labels = O.joined_by(links, labels)
    assert sorted((bytes(r.node), bytes(r.label)) for r in labels.collect()) == [(n, nodes[0]) for n in nodes]
    assert O.links_across(members, labels, held).isEmpty()


def test_a_large_component_meets_lone_texts_without_all_pairs(spark, monkeypatch):
    # 150 near copies in one component; 20 texts too far from all of them, and three near one of them only
    rnd = random.Random(13)
    base = [f"w{i}" for i in range(100)]
    texts = [edited(rnd, base, 6) for _ in range(150)]
    texts += [edited(rnd, base, 32) for _ in range(20)] + [edited(rnd, texts[i], 16) for i in (7, 70, 140)]
    nodes = [f"n{i:03}".encode() for i in range(len(texts))]
    true = {n: nodes[0] if i < 150 else n for i, n in enumerate(nodes)}
    linked = [(a, b) for (a, x), (b, y) in itertools.combinations(zip(nodes, texts), 2) if b > nodes[149] and O.alike(x, y)]
    for a, b in linked:
        low, high = sorted((true[a], true[b]))
        true = {n: low if v == high else v for n, v in true.items()}
    assert 3 <= len(linked) <= 150 and len(set(true.values())) > 10
    members = spark.createDataFrame([(1, n, len(t), len(texts)) for n, t in zip(nodes, texts)], "bucket long, node binary, n_words int, size long")
    labels = spark.createDataFrame([(n, nodes[0]) for n in nodes[:150]], "node binary, label binary")
    held = spark.createDataFrame([(n, " ".join(t)) for n, t in zip(nodes, texts)], "node binary, text string")
    made, materialise = {}, O.materialise

    def counted(df, name):
        out = materialise(df, name)
        made[name] = max(made.get(name, 0), out.count())
        return out

    monkeypatch.setattr(O, "materialise", counted)
    got = O.joined_by(O.links_across(members, labels, held), labels)
    assert made["pairs"] <= 23 + 23 * 22 / 2
    got = {bytes(r.node): bytes(r.label) for r in got.collect()}
    assert {n: got.get(n, n) for n in nodes} == true


def test_links_join_components_and_lone_nodes(spark):
    labels = spark.createDataFrame([(b"b", b"a"), (b"a", b"a"), (b"d", b"c"), (b"c", b"c"), (b"y", b"x"), (b"x", b"x")], "node binary, label binary")
    links = spark.createDataFrame([(b"d", b"e"), (b"b", b"d"), (b"b", b"c"), (b"x", b"y")], "a binary, b binary")
    got = sorted((bytes(r.node), bytes(r.label)) for r in O.joined_by(links, labels).collect())
    assert got == [(bytes([c]), b"a") for c in b"abcde"] + [(b"x", b"x"), (b"y", b"x")]


def test_components_need_no_jobs_beside_their_writes(spark, monkeypatch):
    rnd = random.Random(11)
    stars = [(5 * i, 5 * i + j) for i in range(40) for j in range(1, 5)]
    chain = [(i, i + 1) for i in range(300, 340)]
    mixed = [(rnd.randrange(400, 520), rnd.randrange(400, 520)) for _ in range(90)]
    frame, node = type(spark.range(1)), lambda i: i.to_bytes(4, "big")
    writes, write = [], O.materialise

    def kept(df, name):
        writes.append(name)
        return write(df, name)

    def refuse(*_):
        raise AssertionError("a job of its own")

    for edges, most in ((stars, 2), (chain, 99), (stars + chain + mixed * 2 + [(600, 600)], 99), ([], 1)):
        label = {i: i for edge in edges for i in edge if edge[0] != edge[1]}
        for _ in label:
            for a, b in edges:
                if a != b:
                    label[a] = label[b] = min(label[a], label[b])
        rows = spark.createDataFrame([(bytearray(node(b)), bytearray(node(a))) for a, b in edges], "a binary, b binary")
        writes.clear()
        with monkeypatch.context() as m:
            m.setattr(O, "materialise", kept)
            for action in ("first", "count", "isEmpty", "collect"):
                m.setattr(frame, action, refuse)
            found = O.components(rows)
        assert len(writes) <= most
        assert {(bytes(r.node), bytes(r.label)) for r in found.collect()} == {(node(i), node(x)) for i, x in label.items()}
        assert found.count() == len(label)


def test_the_rarest_disjoint_windows_are_chosen():
    rnd = random.Random(6)
    for _ in range(300):
        n = rnd.randrange(1, 40)
        every = [(at, length) for length in range(1, O.WINDOW + 1) for at in range(n - length + 1)]
        held = {w: rnd.randrange(2, 9) for w in every if w[1] == 1 or rnd.random() < 0.8}
        given = [O.np.array(x) for x in ([w[0] for w in held], [w[1] for w in held], list(held.values()))]
        chosen = [list(held)[i] for i in O.rarest(n, *given)]
        covered = [i for at, length in chosen for i in range(at, at + length)]
        assert len(covered) == len(set(covered)) and len(chosen) <= O.allowed(n) + 1
        if len(held) == len(every):
            assert len(chosen) == O.allowed(n) + 1


def test_lone_near_copies_share_a_class(make_docs):
    # pairs only, no third copy as a bridge; words replaced all over the text; every pair links by alignment
    rnd = random.Random(11)
    texts, share = [], {}
    for part in (0.05, 0.07, 0.10, 0.20):
        for _ in range(100):
            base = [f"w{rnd.randrange(10**5)}" for _ in range(rnd.randrange(100, 400))]
            near = list(base)
            for i in rnd.sample(range(len(base)), int(part * len(base))):
                near[i] = f"s{rnd.randrange(10**6)}"
            assert O.alike(base, near)
            share.setdefault(part, []).append(len(texts))
            texts += [" ".join(base), " ".join(near)]
    got = {r.doc_id: r.class_id for r in O.classes(make_docs(list(enumerate(texts)))).collect()}
    found = {part: sum(got[i] == got[i + 1] for i in at) for part, at in share.items()}
    assert [found[p] for p in (0.05, 0.07, 0.10)] == [100] * 3 and found[0.20] >= 95, found


def test_short_texts_that_link_always_share_a_sketch():
    rnd = random.Random(12)
    linked = 0
    for _ in range(2000):
        base = [f"w{rnd.randrange(10**4)}" for _ in range(rnd.randrange(1, O.SHORT))]
        near = edited(rnd, base, 1)
        if 0 < len(near) < O.SHORT and O.alike(base, near):
            linked += 1
            assert set(O.sketch(" ".join(base))) & set(O.sketch(" ".join(near)))
    assert linked > 500


def test_a_shared_passage_brings_no_pairs(spark, make_docs):
    # 400 unrelated texts share a passage that is 60 % of each: one bucket, one pair of copies, no square
    rnd = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join(passage + [f"w{rnd.randrange(10**6)}" for _ in range(40)]) for _ in range(400)]
    near = {}
    for part in (0.05, 0.1, 0.15):  # copies of some of them, edited all over
        for i in rnd.sample(range(400), 60):
            words = texts[i].split()
            for j in rnd.sample(range(100), int(100 * part)):
                words[j] = f"s{rnd.randrange(10**6)}"
            near[len(texts)] = (part, i)
            texts.append(" ".join(words))
    got = {r.doc_id: r.class_id for r in O.classes(make_docs(list(enumerate(texts)))).collect()}
    lost = [part for k, (part, i) in near.items() if got[k] != got[i]]
    assert lost.count(0.05) == lost.count(0.1) == 0 and lost.count(0.15) <= 3, lost
    true = {i: i for i in range(len(texts))}
    for i, j in itertools.combinations(true, 2):  # nothing links but what aligns
        if got[i] == got[j] and O.alike(texts[i].split(), texts[j].split()):
            low, high = sorted((true[i], true[j]))
            true = {k: low if v == high else v for k, v in true.items()}
    assert got == true


def test_keep_one_returns_columns_of_any_name(spark):
    rows = [(i, f"some text number {i % 3}", "n", "k", 1, "r", "l") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, _node string, _key int, row string, `a.b` string")
    kept = O.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == rows[:3]


def test_registered_query_groups_equal_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    words = {r.doc_id: O.words_of(r.text or "") for r in docs}
    label = {i: i for i in words}
    for i, j in itertools.combinations(sorted(words), 2):
        if O.alike(words[i], words[j]) and label[i] != label[j]:
            low, high = sorted((label[i], label[j]))
            label = {k: low if v == high else v for k, v in label.items()}
    got = {r.doc_id: r.class_id for r in O.op4_order_minhash(spark, folder).collect()}
    assert got == label


def test_edge_cases(make_docs):
    long = " ".join(f"w{i}" for i in range(30_000))
    docs = make_docs([(5, None), (4, ""), (9, "one"), (8, "one"), (8, "one"), (None, "two words"), (7, long), (6, long + " end"),
                      (3, "   "), (None, "one")])
    rows = O.classes(docs).collect()
    got = sorted((str(r.doc_id), str(r.class_id)) for r in rows)
    assert got == sorted([("5", "4"), ("4", "4"), ("9", "8"), ("8", "8"), ("8", "8"), ("None", "None"), ("7", "6"),
                          ("6", "6"), ("3", "3"), ("None", "8")])
    kept = O.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "6", "8", "None"]
    assert O.classes(make_docs([])).count() == 0
