"""Operators over whole tables against brute force, and the pipeline's stages."""

import gzip
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_fixtures import docs  # noqa: F401
from locusdeck.llm import components, queries, seeds, simhash, spots, templates, urls, warc
from locusdeck.llm.shared import attach

SF = "/root/testdata/sf0.001"
WORDS = [a + b for a in "ba be bi bo bu da de di do du ka ke ki ko ku".split() for b in "na ne ni no nu sa se si".split()]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def test_components_of_random_graphs(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(rnd.randrange(100, 200), rnd.randrange(100, 200)) for _ in range(60)]
    root = list(range(200))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: top(x) for x in nodes}


def test_attach_splits_hot_keys(spark):
    left = spark.createDataFrame([(i, 7 if i % 3 else i) for i in range(90)] + [(-1, None)], "id long, k long")
    right = spark.createDataFrame([(7, 60, "hot"), (3, 1, "cold")], "k long, n long, v string")
    found = {r["id"]: r["v"] for r in attach(left, right, "k", "n", least=10).collect()}
    assert found == {i: "hot" if i % 3 else ("cold" if i == 3 else None) for i in range(90)} | {-1: None}


def test_balls_find_all_links(spark):
    rnd = random.Random(6)
    base = [rnd.getrandbits(64) for _ in range(6)]
    fps = set(base) | {b ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for b in base for _ in range(8)} | {0, 1, 3, 7, 1 << 63}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(i, signed(x)) for i, x in enumerate(sorted(fps))] + [(1000, 0), (None, 1)]
    found = simhash.groups(spark.createDataFrame(rows, "doc_id long, fp long")).collect()
    ids = {}
    for i, x in rows:
        ids.setdefault(x, []).append(i)
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    for r in found:
        seen, todo = set(), [r["fp"]]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += [y for y in ids if near(x, y)]
        assert r["component_id"] == min(i for x in seen for i in ids[x] if i is not None)


def test_one_of_each_group_stays(docs):
    rnd = random.Random(8)
    a, b = prose(rnd, 80), prose(rnd, 80)
    rows = [(5, a), (3, a), (3, a), (9, b), (9, prose(rnd, 60)), (None, b), (11, None), (12, ""), (20, prose(rnd, 50))]
    kept = Counter((r["doc_id"], r["text"]) for r in simhash.one_of_each(docs(rows)).collect())
    assert kept == Counter({(3, a): 1, (9, b): 1, rows[4]: 1, (11, None): 1, rows[8]: 1})
    assert simhash.one_of_each(docs(rows).limit(0)).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows_and_any_column_names(spark, docs, name, stage):
    rnd = random.Random(77)
    a = prose(rnd, 60)
    rows = [(1, a), (1, a), (2, None), (None, a), (None, None), (3, ""), (4, prose(rnd, 50)), (5, "word " * 20_000), (4, prose(rnd, 40)), (None, "x y z")]
    names = ["fp", "root", "component_id", "_fp", "_odd", "row", "key", "t", "item", "pos", "leaf", "_text", "score", "least", "n", "_nth", "held"]
    frame = docs(rows).withColumns({c: F.lit(c) for c in names}).withColumn("a.b", F.lit(1))
    found = stage(spark, frame, SF)
    kept = found.collect()
    if name == "sentencepiece":
        assert len(kept) == len(rows)
    else:
        assert found.columns == frame.columns and 0 < len(kept) <= len(rows)
        assert Counter((r["doc_id"], r["text"]) for r in kept) <= Counter(rows)
        assert all(r["fp"] == "fp" and r["a.b"] == 1 for r in kept)
    assert stage(spark, frame.limit(0), SF).count() == 0


def test_recurring_templates_go(docs):
    rnd = random.Random(9)
    passage = prose(rnd, 60)
    own = [prose(rnd, 40) + "\n" + prose(rnd, 30) for _ in range(6)]
    rows = [(i, f"{t}\n{passage}\norder 66{i} of {i} items was shipped on day {i}4 to them\nok") for i, t in enumerate(own[:4])]
    copied = "\n".join(prose(rnd, 25) for _ in range(6))
    rows += [(10 + i, copied) for i in range(3)] + [(13, copied.replace(WORDS[0], WORDS[1], 1))]
    rows += [(20, own[4]), (21, None), (22, ""), (None, own[5]), (20, own[4])]
    found = templates.without_recurring(docs(rows), counts=True).collect()
    left = {(r["doc_id"], r["text"]) for r in found}
    assert len(found) == len(rows)
    assert left >= {(i, f"{t}\nok") for i, t in enumerate(own[:4])}
    assert left >= set(rows[4:])  # copies are left to document dedup, clean texts as they are
    assert all(r["n_chars"] == len(r["text"] or "") for r in found)
    similar = [(i, f"{own[i]}\n" + " ".join(passage.split()[:52] + [prose(rnd, 1) for _ in range(8)])) for i in range(4)]
    assert {r["text"] for r in templates.without_recurring(docs(similar)).collect()} == set(own[:4])


def test_near_copies_of_one_line_stay(docs):
    rnd = random.Random(12)
    line, passage, own = prose(rnd, 200), prose(rnd, 60), [prose(rnd, 40) for _ in range(3)]
    copies = [(i, " ".join([*line.split()[:-1], f"end{chr(97 + i)}"])) for i in range(9)]
    rows = copies + [(20 + i, f"{t}\n{passage}") for i, t in enumerate(own)] + [(30, passage), (31, passage)]
    left = {(r["doc_id"], r["text"]) for r in templates.without_recurring(docs(rows)).collect()}
    assert left == set(copies) | {(20 + i, t) for i, t in enumerate(own)} | {(30, ""), (31, "")}


def test_one_family_of_copies_does_not_outvote_the_others(docs):
    rnd = random.Random(31)
    passage, own = prose(rnd, 40), [prose(rnd, 30) for _ in range(6)]
    body = [prose(rnd, 30) for _ in range(4)]
    copies = []
    for i in range(20):  # near copies: one word of one line changed, in some among the leading ones
        lines = [x.split() for x in body]
        lines[i % 4][i % 30] = f"new{chr(97 + i)}"
        copies.append((100 + i, "\n".join([*map(" ".join, lines), passage])))
    rows = [(i, f"{t}\n{passage}") for i, t in enumerate(own)] + copies
    left = {r["doc_id"]: r["text"] for r in templates.without_recurring(docs(rows)).collect()}
    assert {i: left[i] for i in range(6)} == dict(enumerate(own))
    assert all(left[i] == t for i, t in copies)  # one family by itself: left to document dedup


def test_heavily_edited_copies_stay(docs):
    rnd = random.Random(33)
    body = [prose(rnd, rnd.choice([5, 8, 20, 40])) for _ in range(20)]
    change = lambda x: " ".join(rnd.choice(["qua", "que", "quo"]) + w if rnd.random() < 0.1 else w for w in x.split())
    rows = [(i, "\n".join(map(change, body))) for i in range(12)]
    assert {(r["doc_id"], r["text"]) for r in templates.without_recurring(docs(rows)).collect()} == set(rows)


@pytest.mark.parametrize("shared, own", [(5, 1), (5, 5), (10, 1), (10, 5)])
def test_blocks_of_shared_lines_go(docs, shared, own):
    rnd = random.Random(shared * 10 + own)
    block = [prose(rnd, 12) for _ in range(shared)]
    mine = ["\n".join(prose(rnd, 15) for _ in range(own)) for _ in range(20)]
    rows = [(i, "\n".join([*block[:2], t, *block[2:]])) for i, t in enumerate(mine)]
    left = {r["doc_id"]: r["text"] for r in templates.without_recurring(docs(rows)).collect()}
    assert left == dict(enumerate(mine))


def _template_keys(texts, least, depth=3):
    """The rule of the module's text, line by line: (text, line) -> template."""
    lines = {}
    for k, text in enumerate(texts):
        for pos, line in enumerate(text.split("\n")):
            t = [templates.WILD if re.search("[0-9]", x) else x for x in line.split()]
            if len(t) >= templates.MIN_TOKENS:
                lines[k, pos] = t
    leaves = {}
    for place, t in lines.items():
        n = len(t)
        leaves[place] = [("first", n, *t[:depth]), ("later", n, *t[depth : 2 * depth]) if n > depth else None, ("last", n, *t[-depth:]) if n > 2 * depth else None]
    held = Counter(x for own in leaves.values() for x in own if x)
    leaf, fields = {}, {}
    for place, t in lines.items():
        good = [(held[x] * (4, 2, 1)[i], -i, x) for i, x in enumerate(leaves[place]) if x and held[x] >= least]
        if good:
            leaf[place] = max(good, key=lambda g: g[:2])[2]
            run = -(-len(t) // templates.FIELDS)
            fields[place] = [tuple(t[i : i + run]) for i in range(0, len(t), run)]
    rows = Counter(leaf.values())
    value = Counter((leaf[p], j, x) for p in leaf for j, x in enumerate(fields[p]))
    out = {}
    for p in leaf:
        n, own = len(lines[p]), [value[leaf[p], j, x] for j, x in enumerate(fields[p])]
        kept = sorted((c for c in own if c >= least), reverse=True)
        skip = 0 if n > templates.FIELDS else min(depth, n - depth) if leaf[p][0] == "later" else min(depth, n)
        half = -(-(len(own) - skip) // 2)
        m = rows[leaf[p]] if not half else kept[skip + half - 1] if skip + half <= len(kept) else 0
        if m >= least:
            constant = [(j, x) for j, x in enumerate(fields[p]) if own[j] >= least and own[j] * 2 >= m]
            if len(constant) == len(own) or m * templates.DOMINANT >= rows[leaf[p]] or len(constant) - skip >= templates.EVIDENCE:
                out[p] = (leaf[p], *constant)
    return out


def test_templates_by_brute_force(spark, docs):
    rnd = random.Random(51)
    few = WORDS[:25]
    bodies = [
        lambda: f"alpha {rnd.choice(WORDS)} beta gamma {rnd.choice(few)} delta eps zeta {rnd.choice(few)} eta theta",
        lambda: f"{rnd.choice(WORDS)} posted by you in the news",
        lambda: f"total {rnd.randrange(99)} of items",
        lambda: " ".join(rnd.choice(few) for _ in range(rnd.choice([3, 4, 5, 9]))),
        lambda: prose(rnd, 7) + " one two three four five six seven eight nine ten eleven twelve " + prose(rnd, 2),
        lambda: "",
        lambda: "\t".join(rnd.choice(few) for _ in range(4)) + "  x",
    ]
    texts = list(dict.fromkeys("\n".join(rnd.choice(bodies)() for _ in range(rnd.randrange(1, 9))) for _ in range(150)))
    want = _template_keys(texts, 3)
    by_hash = {r["h"]: texts[r["doc_id"]] for r in docs(list(enumerate(texts))).select("doc_id", F.xxhash64("text").alias("h")).collect()}
    frame = docs(list(enumerate(texts)))
    found = templates._templates(frame, templates.parsed_lines(frame), 3, 3).collect()
    got = {(texts.index(by_hash[r["text_hash"]]), r["pos"]): r["key"] for r in found}
    assert len(got) == len(found) and got.keys() == want.keys() and len(want) > 100
    assert len({(got[p], want[p]) for p in want}) == len(set(got.values())) == len(set(want.values()))


@pytest.mark.parametrize(
    "line",
    [
        "dear {} we have sent the parcel that you asked for to the town today",
        "dear friend we have sent the parcel of {} that you asked for to the town of {} today with love",
        "on {} the report of {} was read by all and the vote of {} was held in the end as it was before",
        "{} posted this in the great hall of news",
        "by {} posted in the great hall of {} news today",
        "it was {}",
        "posted by {} in news",
    ],
)
def test_templates_with_word_fields_go(docs, line):
    """60 unrelated documents share a line whose fields hold words, some of them often."""
    rnd = random.Random(len(line))
    own = [prose(rnd, 30) + "\n" + prose(rnd, 20) for _ in range(60)]
    name = lambda: rnd.choice(WORDS) + rnd.choice(WORDS) if rnd.random() < 0.7 else rnd.choice(WORDS[:6])
    rows = [(i, f"{t}\n{line.format(name(), name(), name())}") for i, t in enumerate(own)]
    left = {r["doc_id"]: r["text"] for r in templates.without_recurring(docs(rows)).collect()}
    clean = sum(left[i] == t for i, t in enumerate(own))
    assert all(left[i].startswith(t) for i, t in enumerate(own))
    # Lines of three tokens have nothing but their leading tokens to go by.
    assert clean == 0 if line == "it was {}" else clean >= 54


def test_prose_of_common_words_stays(docs):
    rnd = random.Random(61)
    common = ["the", "of", "and", "to", "in", "is", "a", "it"]
    sentence = lambda: " ".join(rnd.choice(common) if rnd.random() < 0.5 else rnd.choice(WORDS) for _ in range(rnd.randrange(5, 14)))
    rows = [(i, "\n".join(sentence() for _ in range(12))) for i in range(400)]
    left = {r["doc_id"]: r["text"] for r in templates.without_recurring(docs(rows)).collect()}
    kept = sum(len(left[i].split("\n")) for i, _ in rows)
    assert kept >= 0.995 * 400 * 12


def _spots(text):
    common, out = set(spots.ANCHORS), set()
    w = text.lower().split()
    content = [i for i, x in enumerate(w) if x not in common]
    for k, i in enumerate(content):
        if i > 0 and w[i - 1] in common and k + spots.CHAIN <= len(content):
            out.add((w[i - 1], *(w[j] for j in content[k : k + spots.CHAIN])))
    return out or {tuple(w)}


def test_spots_next_and_edited(docs, monkeypatch):
    monkeypatch.setattr(spots, "GROUP_ROWS", 5)
    rnd = random.Random(10)
    mixed = lambda n: " ".join(rnd.choice(["the", "of", "and", *WORDS[:40]]) for _ in range(n))
    rows = [(i * 7, mixed(rnd.choice([3, 20, 60]))) for i in range(40)] + [(3, ""), (4, None), (281, "é🙂ö the x y"), (None, "the one")]
    rows += [(50, rows[3][1])]
    found = {(r["doc_id"], r["text"]): r for r in spots.edited(docs(rows)).collect()}
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert len(found) == len(ordered)
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        r = found[i, text]
        half = len(text) // 2
        assert r["n_chars"] == len(text) and r["edited"] == text[: len(text) - half] + after[:half]
        a, b = _spots(text), _spots(after)
        assert len(r["signs"]) == len(a) and r["near_next"] == pytest.approx(len(a & b) / len(a | b))


def test_near_pairs_are_those_of_brute_force(docs):
    rnd = random.Random(11)
    mixed = lambda n: [rnd.choice(["the", "of"] if rnd.random() < 0.4 else WORDS) for _ in range(n)]
    rows = []
    for k in range(8):
        w = mixed(120)
        for j in range(3):
            v = list(w)
            for _ in range(j):
                v[rnd.randrange(len(v))] = rnd.choice(WORDS)
            rows.append((k * 10 + j, " ".join(v)))
    rows.append((500, rows[0][1]))
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(_spots(t)), i)
    want = {(max(a, b), min(a, b)) for s, a in sets.items() for t, b in sets.items() if a != b and len(s & t) >= 0.8 * len(s | t)}
    found = {(max(r["a"], r["b"]), min(r["a"], r["b"])) for r in spots.near_pairs(docs(rows)).collect()}
    assert found == want and want


def test_substituted_benchmark_items_are_found(spark, docs):
    rnd = random.Random(12)
    items = [(i, prose(rnd, 40)) for i in range(5)] + [(5, "ba be ko"), (6, prose(rnd, 9)), (7, None), (0, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def changed(t, k):
        w = t.split()
        for p in range(k, len(w), 8):
            w[p] = "zzz"
        return " ".join(w)

    rows = [(1, prose(rnd, 100) + " " + items[0][1] + " " + prose(rnd, 30)), (2, changed(items[1][1], 3)), (3, prose(rnd, 300))]
    rows += [(4, "ba be ko " + prose(rnd, 60)), (5, prose(rnd, 20) + " " + items[6][1]), (6, None), (7, ""), (None, items[2][1].upper()), (2, rows[1][1])]
    found = {(r["doc_id"], r["item_id"]) for r in seeds.contaminated(docs(rows), bench).collect()}
    assert found == {(1, 0), (2, 1), (5, 6), (None, 2)}
    kept = [r["doc_id"] for r in seeds.clean(docs(rows), bench).collect()]
    assert sorted(kept) == [3, 4, 6, 7]
    assert seeds.clean(docs(rows), bench.limit(0)).count() == len(rows)


def test_the_masks_reach_every_accepted_pattern():
    for n in range(seeds.LEAST, seeds.WINDOW + 1):
        fewest = None
        for wrong in itertools.combinations(range(n), n - -(-n * 4 // 5)):
            places = [[i for i, c in enumerate(m) if c == "1"] for m in seeds.MASKS]
            found = sum(all(a + i not in wrong for i in p) for m, p in zip(seeds.MASKS, places) for a in range(n - len(m) + 1))
            fewest = found if fewest is None else min(fewest, found)
        assert fewest == seeds.least_hits(n, n - -(-n * 4 // 5)) > 0


@pytest.mark.parametrize("n", [5, 9, 10, 12, 13, 16, 20, 30])
def test_every_pattern_of_substitutions_is_found(spark, docs, n):
    """All patterns (of 30 tokens: random ones) that the comparison accepts, and those with one more that it does not."""
    rnd = random.Random(n)
    item = rnd.sample(WORDS, n)
    most = min(n, 20) - -(-min(n, 20) * 4 // 5)
    patterns = list(itertools.combinations(range(n), most)) if n <= 20 else [tuple(rnd.sample(range(5, 25), most)) for _ in range(300)]
    rows = []
    for i, wrong in enumerate(patterns):
        w = [f"new{chr(97 + k % 26)}" if k in wrong else x for k, x in enumerate(item)]
        rows.append((i, " ".join(["aa bb", *w, "cc dd"])))
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r["doc_id"] for r in seeds.contaminated(docs(rows), bench).collect()}
    assert found == set(range(len(rows)))
    if n <= 20:
        over = [tuple(rnd.sample(range(n), most + 1)) for _ in range(60)]
        rows = [(i, " ".join(f"new{k}" if k in wrong else x for k, x in enumerate(item))) for i, wrong in enumerate(over)]
        assert seeds.contaminated(docs(rows), bench).count() == 0


def _overlaps(text, items):
    """Items of which some 20 tokens in a row (all of a shorter one) agree in 0.8 of their places, by trying all places."""
    w, out = re.findall(r"[^\W_]+", (text or "").lower()), set()
    for key, t in items:
        v = re.findall(r"[^\W_]+", (t or "").lower())
        size = min(len(v), 20)
        if 0 < len(v) < seeds.LEAST and v == w:
            out.add(key)
        if len(v) >= seeds.LEAST:
            for a in range(len(v) - size + 1):
                for b in range(len(w) - size + 1):
                    if sum(x == y for x, y in zip(v[a : a + size], w[b : b + size])) >= size * 0.8 - 1e-9:
                        out.add(key)
    return out


def test_contamination_by_brute_force(spark, docs):
    rnd = random.Random(41)
    few = WORDS[:12]  # so few words that seeds meet by chance
    text = lambda n, of=few: " ".join(rnd.choice(of) for _ in range(n))
    items = [(i, text(rnd.choice([1, 3, 5, 7, 12, 25]), rnd.choice([few, WORDS]))) for i in range(25)] + [(90, None), (91, ""), (92, "ba")]
    rows = [(i, text(rnd.choice([1, 4, 20, 60]))) for i in range(60)] + [(100, "Ba!"), (101, None), (102, ""), (None, items[4][1]), (104, items[6][1])]
    rows += [(200 + i, text(9, WORDS) + " " + items[i][1] + " " + text(9, WORDS)) for i in range(25)] + [rows[3]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = docs(rows).withColumns({"t": F.lit("clash"), "seed": F.lit(1), "item": F.lit(2), "item_id": F.lit(3)})
    found = {(r["doc_id"], r["item_id"]) for r in seeds.contaminated(frame, bench).collect()}
    want = {(i, k) for i, t in rows for k in _overlaps(t, items)}
    assert found == want and len(want) > 15
    bad = {i for i, _ in want}
    kept = seeds.clean(frame, bench)
    assert kept.columns == frame.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, _ in rows if i not in bad)


def test_archives_round_trip(spark, tmp_path):
    rnd = random.Random(13)
    rows = [(i, f"http://h/{i}", prose(rnd, 200)) for i in range(60)] + [(100, None, None), (101, "http://x y\r\n", ""), (102, "u", "same é")]
    rows += [(103, "u", "same é"), (104, "v", "same é"), (104, "v", "same é"), (None, "n", "no id"), (60, "w", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folders = [str(tmp_path / n) for n in "ab"]
    manifests = [
        warc.write(p, f, shard_bytes=20_000, file_bytes=2_000).orderBy("final").select("final", "sha256", "records").collect()
        for p, f in zip((pages, pages.repartition(5)), folders)
    ]
    assert manifests[0] == manifests[1] and len(manifests[0]) > 5  # equal files whatever the tasks
    got = warc.read(spark, folders[0]).collect()
    assert len(got) == len(rows)
    assert Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got if r["payload_bytes"] == len("same é".encode())) == Counter(
        {(102, "revisit", 104): 1, (103, "revisit", 104): 1, (104, "response", None): 2}
    )
    text = {r["page_id"]: r["payload"] for r in got}
    assert all(text[i] == h for i, _, h in rows[1:60]) and text[0] is None and text[60] == rows[0][2]
    for page, _, html in rows:
        assert any(r["page_id"] == page and r["payload_digest"] == warc.sha1_base32((html or "").encode()) for r in got)


def _shards(spark, rows, tmp_path, **how):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folders = [str(tmp_path / n) for n in ("one", "two")]
    found = [warc.write(p, f, file_bytes=1 << 20, **how).orderBy("final") for p, f in zip((pages, pages.repartition(7)), folders)]
    listed = [[(r["final"], r["sha256"]) for r in m.collect()] for m in found]
    assert listed[0] == listed[1]
    per_shard = {}
    for name in sorted(n for n, _ in listed[0]):
        with gzip.open(f"{folders[0]}/{name}") as stream:
            per_shard.setdefault(name.split("-")[1], []).extend(r[0] for r in warc.records_of(stream))
    got = Counter((r["page_id"], r["url"], r["payload_bytes"]) for r in warc.read(spark, folders[0]).collect())
    assert got == Counter((i, u, len((h or "").encode())) for i, u, h in rows)
    return [per_shard[k] for k in sorted(per_shard)]


def test_shards_are_ranges_of_ids_whatever_their_spread(spark, tmp_path):
    rnd = random.Random(71)
    rows = [(i, f"u{i}", prose(rnd, 60)) for i in range(400)] + [(10**15, "far", "x"), (-(2**62), "low", "y"), (2**62, "high", "z")]
    shards = _shards(spark, rows, tmp_path, shard_bytes=20_000)
    assert len(shards) > 10 and max(map(len, shards)) < 60
    assert all(a[-1] < b[0] for a, b in zip(shards, shards[1:]))


def test_equal_records_are_dealt_to_several_shards(spark, tmp_path):
    rows = [(7, "u", "same text " * 30)] * 500 + [(7, f"v{i}", f"other {i}") for i in range(20)] + [(3, "a", "b"), (None, "n", None)]
    shards = _shards(spark, rows, tmp_path, shard_bytes=40_000)
    assert len(shards) > 5 and max(map(len, shards)) < 200
    ids = [i for s in shards for i in s]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_empty_pages_and_pages_without_ids_take_space(spark, tmp_path):
    shards = _shards(spark, [(i, None, None) for i in range(600)] + [(None, f"n{i}", None) for i in range(300)], tmp_path, shard_bytes=50_000)
    assert len(shards) > 8 and max(map(len, shards)) < 200


def test_a_file_that_is_not_the_manifests_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"text {i}") for i in range(5)], "page_id long, url string, html string")
    (row,) = warc.write(pages, str(tmp_path / "w")).collect()
    path = tmp_path / "w" / row["final"]
    with gzip.open(path) as stream:
        whole = stream.read()
    path.write_bytes(gzip.compress(whole))  # the same records, packed anew
    with pytest.raises(Exception, match="not the file of the manifest"):
        warc.read(spark, str(tmp_path / "w")).collect()


def _verdict(url):
    rest = (url or "").partition("://")[2]
    host = rest
    for c in "/?#":
        host = host.partition(c)[0]
    path = rest[len(host) :].partition("?")[0].partition("#")[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fit, key=lambda r: len(r.text)) if fit else None


def test_urls(spark):
    odd = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.org/en/1?x", "http://org", "http://org/", "http://aÉ.Example.ORG/es/#f", "x://com/fr/?a", "http://com/de", "http://a.com/fr/://x"]
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").unionByName(
        spark.createDataFrame([(1000 + i, u) for i, u in enumerate(odd)] + [(None, "http://z.org/a")], "page_id long, url string")
    )
    found = urls.judged(pages).collect()
    url = {r["page_id"]: r["url"] for r in pages.collect()}
    assert len(found) == pages.count()
    for r in found:
        host, path, rule = _verdict(url[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.text)
        assert r["verdict"] == (rule.verdict if rule else r["verdict"]) and r["verdict"] in ("allow", "block")


def test_character_models_by_brute_force(spark):
    seen = [("ab", 2, "allow"), ("ac", 1, "block"), ("abc", 1, None), ("abd", 3, "block")]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(seen)], "id long, url string, w long, verdict string")
    found = {(r["context"], r["char"]): r["ratio"] for r in urls.ratios(frame, 2).collect()}
    from math import log

    grams = [(u, w, v, "\x02\x02" + u + "\x03") for u, w, v in seen]
    alphabet = {c for *_, p in grams for c in p[2:]}

    def p(context, c, side):
        own = [(g[i - len(context) : i], g[i], w) for _, w, v, g in grams if v == side for i in range(2, len(g))]
        if not context:
            return (sum(w for _, x, w in own if x == c) + 1) / (sum(w for *_, w in own) + len(alphabet))
        own = [(x, w) for k, x, w in own if k == context]
        n, kinds, lower = sum(w for _, w in own), len({x for x, _ in own}), p(context[1:], c, side)
        return (sum(w for x, w in own if x == c) + kinds * lower) / (n + kinds) if n else lower

    for (context, c), ratio in found.items():
        assert abs(ratio - 1e6 * log(p(context, c, "allow") / p(context, c, "block"))) < 2


def test_scores_and_threshold_by_brute_force(spark):
    rnd = random.Random(15)
    seen = {"".join(rnd.choice(of) for _ in range(rnd.randrange(0, 9))): v for of, v in (("abc", "allow"), ("bcd", "block"), ("abcd", None)) for _ in range(25)}
    rows = [(i, u, rnd.randrange(1, 4), v) for i, (u, v) in enumerate(seen.items())]
    frame = spark.createDataFrame(rows, "id long, url string, w long, verdict string")
    ratio = {(r["context"], r["char"]): r["ratio"] for r in urls.ratios(frame, 2).collect()}
    found = {r["id"]: r["score"] for r in urls.scores(frame, 2).collect()}
    for i, u, _, _ in rows:
        g = urls.BEGIN * 2 + u + urls.END
        each = [ratio[g[k - 2 : k], g[k]] for k in range(2, len(g))]
        assert found[i] == sum(each) // len(each)
    rated = spark.createDataFrame([(w, v, found[i]) for i, _, w, v in rows], "w long, verdict string, score long")
    bar = urls.threshold(rated)

    def balanced(bar):
        share = lambda v, good: sum(w for i, _, w, x in rows if x == v and good(found[i])) / sum(w for *_, w, x in rows if x == v)
        return share("allow", lambda s: s >= bar) + share("block", lambda s: s < bar)

    assert balanced(bar) == pytest.approx(max(balanced(k * urls.STEP) for k in range(min(found.values()) // urls.STEP, max(found.values()) // urls.STEP + 2)))
    assert urls.threshold(rated.filter("verdict = 'allow'")) == 0


def test_the_models_do_not_know_the_verdicts_they_are_calibrated_on(spark, monkeypatch):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    asked, seen = [], []
    scores, threshold = urls.scores, urls.threshold
    monkeypatch.setattr(urls, "scores", lambda u, order: seen.append(u.filter("verdict IS NOT NULL")) or scores(u, order))
    monkeypatch.setattr(urls, "threshold", lambda r: asked.append(r.filter("verdict IS NOT NULL")) or threshold(r))
    urls.judged(pages).count()
    assert asked[0].count() > 0 and seen[0].count() > 2 * asked[0].count()
    assert asked[0].join(seen[0], "url").count() == 0


def test_the_pipeline_runs_and_keeps_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).columns == docs.columns
        assert stage(spark, docs, SF).columns == docs.columns, name
    found = corpus_pipeline.run(spark, SF)
    assert 0 < found.count() <= docs.count() and found.select("doc_id").distinct().count() == found.count()


def test_every_query_takes_empty_tables(spark, tmp_path, monkeypatch):
    for name in ("documents", "pages", "benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, query in queries.QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_columns_change_nothing(spark, docs, tmp_path, monkeypatch):
    """Every query over documents with more columns, named as the operators name their own."""
    rnd = random.Random(91)
    names = ["fp", "root", "row", "key", "t", "item", "at", "seed", "n", "score", "group", "_text", "_id", "signs", "rn", "w", "toxic", "held"]
    plain = docs([(i, prose(rnd, 30) + "\n" + prose(rnd, 12), "en") for i in range(30)] + [(None, None), (3, "x"), (3, "x")])
    wide = plain.withColumns({c: F.lit(c) for c in names})
    tables = {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("benchmark", "labels")}
    found = []
    for frame in (plain, wide):
        monkeypatch.setattr(queries, "read", lambda spark, sf_dir, name, frame=frame: {**tables, "documents": frame}[name])
        found.append({})
        for name, query in queries.QUERIES.items():
            if name not in ("op2_warc", "op9_url_filter", "op12_packing"):
                found[-1][name] = Counter(map(repr, query(spark, "").collect()))
    assert found[0] == found[1]
    assert all(found[0][n] for n in found[0] if n != "op6_decontamination")
