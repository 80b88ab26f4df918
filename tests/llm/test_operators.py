"""The corpus operators against brute-force versions, and on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tenantgraph.llm import packing, pii, queries, shared, simhash, token_scan, topk_search
from tenantgraph.llm.chat_template import Escaper, Template, TemplateError, formatter
from tenantgraph.llm.line_dedup import drop_repeated_lines
from tenantgraph.llm.mixing import mix_sources, mixed
from tenantgraph.llm.quality_rules import measure, quality_rules
from tenantgraph.llm.shared import WORD
from tenantgraph.llm.substring_dedup import batch_units, drop_repeats, repeated_spans
from tenantgraph.llm.tokens import token_bytes
from tenantgraph.llm.topk_search import exact_topk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, size string, band string"
LONG = "Many words follow here. " * 6000


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    texts = [None, "", "  \n\t ", "one", "two words", LONG, "é ж 😀 　x", "a\n\n a b"] + [prose(rng.randint(5, 120)) for _ in range(40)]
    passage = prose(30) + " " + prose(40)
    texts += [texts[20], texts[21], texts[21] + " tail", passage + " " + prose(50), prose(60) + " " + passage, "hot line\n" + prose(9)]
    texts += [f"hot line\n{prose(12)}\nother" for _ in range(12)]
    rows = [(i, t, "en", "hot" if i % 3 else None if i == 9 else f"s{i % 5}", len(t or ""), 1, "x", "y") for i, t in enumerate(texts)]
    rows += [rows[25], (None, "no id here", None, None, None, 1, "x", "y")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def words(text):
    return re.findall(WORD, text or "")


def repeated(w, k):
    at = defaultdict(list)
    for i in range(len(w) - k + 1):
        at[tuple(w[i : i + k])].append(i)
    return len({p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + k)})


def test_quality_rules(docs, none):
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in quality_rules(docs.where("doc_id is not null and doc_id <> 5")).collect():
        w, t = words(text[r.doc_id]), text[r.doc_id] or ""
        lines = [x for x in t.split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t))
        assert (r.n_dup_lines, r.n_repeat_words, r.covered_words) == (len(lines) - len(set(lines)), repeated(w, 5), repeated(w, 10))
        longest = max([k for k in range(1, 60) if repeated(w, k)], default=0)
        assert longest == min(r.longest_repeat, 59)
        assert r.base_failed == (len(w) < 10 or 100 * r.n_repeat_words > 20 * len(w)) and (r.kept is False or not r.base_failed)
    assert quality_rules(docs).count() == docs.count() and quality_rules(none).count() == 0
    rng = random.Random(1)
    for _ in range(300):
        t = " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))).encode()
        m = measure([t, None, t], 5, 10)
        assert m["n_repeat_words"].tolist() == [repeated(t.split(), 5), 0, repeated(t.split(), 5)]


def test_packing(spark, docs, none):
    encode = token_bytes()
    text = {r.doc_id: r.text for r in docs.where("doc_id is not null").collect()}
    out = packing.pack(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()
    pieces, places = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(text)
    for i, own in pieces.items():
        ids = encode(text[i] or "") + b"\0\0\0\0"
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids) // 4
        assert all(zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32 and r.length <= 2048 for r in own)
        assert all(r.length == 2048 for r in own[1:])
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in out)
    assert len(places) <= -(-total // 2048) + 1
    assert packing.pack(none).count() == 0
    assert packing.pack(docs).count() == len(out) + 2  # a repeated row and one without id are packed as well


def check_packed(histogram, capacity, most=1.01):
    """Every piece once, no sequence too long, and few sequences: against the program's bound, or best fit's number where that is less tight."""
    groups = packing.pack_histogram(dict(histogram), capacity)
    packed = Counter()
    for config, n in groups:
        assert sum(config) <= capacity and n > 0
        for s in config:
            packed[s] += n
    assert packed == +Counter(histogram)
    counts = np.zeros(capacity, np.int64)
    for s, n in histogram.items():
        counts[s - 1] = n
    number = sum(n for _, n in groups)
    bound = max(packing.bounds(counts.astype(float)), 0)
    plain = sum(n for _, n in packing.best_fit(counts, [], capacity))
    assert bound - 1e-6 <= number <= max(most * bound, most * plain) + 2, (number, bound, plain)
    return number, plain, packing.program(counts, 0.01)


def test_packing_of_histograms():
    rng = random.Random(3)
    for _ in range(6):
        check_packed(Counter(rng.randint(1, 100) for _ in range(rng.randint(0, 400))), 100)
    for histogram in ({}, {100: 7}, {1: 1}, {51: 40}, {1: 10**6}, {34: 999, 33: 1}, {99: 5, 1: 5}):
        check_packed(histogram, 100)
    for lengths in (range(34, 45), range(51, 70), range(1, 101)):
        check_packed(Counter(rng.choice(lengths) for _ in range(900)), 100, 1.02)


def test_packing_beats_best_fit_where_that_is_poor():
    for histogram in ({84: 600, 60: 600, 61: 600}, {103: 600, 52: 1200, 51: 600, 50: 1200}):
        number, plain, (groups, gaps) = check_packed(histogram, 205)
        assert number <= 0.97 * plain and gaps[0] <= 0.011
        assert packing.used(groups, 205).sum() >= 0.9 * sum(histogram.values())


def test_packing_places_most_pieces_by_the_program():
    rng = random.Random(9)
    for times in (1, 50):
        histogram = Counter({s: n * times for s, n in Counter(min(200, int(rng.lognormvariate(3.6, 0.9)) + 1) for _ in range(1500)).items()})
        number, plain, (groups, gaps) = check_packed(histogram, 200)
        assert number <= plain + 1 and packing.used(groups, 200).sum() >= 0.9 * sum(histogram.values()) and 0 <= gaps[0] <= 0.02


def test_tokens_are_those_of_the_tokenizer():
    rng = random.Random(1)
    encode = token_bytes()
    signs = [" ", "  ", "\n", "a", "B", "'s", "é", "１", "😀", "<|endoftext|>", ".", "　", "\x1c", "1", "ж", "\t"]
    for _ in range(800):
        t = "".join(rng.choice(signs) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(encode(t), "<u4").tolist() == encode.exact.encode(t, add_special_tokens=False).ids


def brute_topk(rows, k=10):
    """rows (id, vector): each query's k best, by Python integers."""
    whole = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[n] = (i, [math.floor(Fraction(x) * 1024) for x in v])
    out = {}
    for q, v in sorted((x for x in whole.values() if x[0] % 100 == 0), reverse=True):
        out[q] = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole.values() if i != q)[:k]
    return out


def check_topk(spark, rows, kind="double", **more):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("score", F.lit("x")).withColumn("a.b", F.lit(1)).repartition(3)
    got = defaultdict(list)
    for r in sorted(exact_topk(df, is_query=F.col("vec_id") % 100 == 0, **more).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((-r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    want = {q: [(max(min(s, 2**63), 1 - 2**63), i) for s, i in x] for q, x in brute_topk(rows).items() if x}
    assert got == want


@pytest.mark.parametrize("more", [{}, {"cell_rows": 20, "block_rows": 2, "n_pivots": 4, "sample_rows": 12}, {"n_pivots": 1}])
def test_exact_topk(spark, more):
    rng = np.random.default_rng(2)
    v = [[float(x) for x in r] for r in rng.normal(size=(260, 8)).round(1).astype(np.float32)]
    rows = list(enumerate(v)) + [(300, None), (301, [1.0, None] + [0.0] * 6), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (None, [1.0] * 8), (7, v[7]), (400, []), (500, [1.0, 2.0])]
    rows += [(100, [9.0] * 8), (100, v[100])] + [(600 + i, v[3]) for i in range(40)]
    check_topk(spark, rows, "float", **more)


@pytest.mark.parametrize("size", [1e5, 5e5, 2e6, 1e9, 1e15, 1e40, 1.5e308])
def test_exact_topk_of_large_components(spark, size):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.uniform(-1, 1, 64) * size]) for i in range(90)] + [(100, [size, 1.0] * 32), (101, [size, 1.0009765625] * 32), (102, [size, 1.0] * 32)]
    check_topk(spark, rows, cell_rows=16, n_pivots=5, sample_rows=20)


def test_exact_topk_without_queries_or_candidates(spark):
    for rows in ([(1, [1.0]), (2, [2.0])], [(100, [1.0])], [(100, [1.0]), (100, [2.0])], [(0, None)], []):
        check_topk(spark, rows)
    check_topk(spark, [(i, [0.5, 0.5]) for i in range(0, 900, 50)])  # ties everywhere


def test_search_passes_over_cells_and_candidates():
    """Near each other, vectors are found without a look at the far ones."""
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(20, 16)) * 50
    x = np.repeat(centers, 100, axis=0) + rng.normal(size=(2000, 16)) * 0.1
    ids = np.arange(2000)
    pivots = topk_search.spread(topk_search.integers(x[::7]).astype(float), 20)
    block = topk_search.Block(topk_search.Side(x[::100], ids[::100], pivots), 10, float((pivots * pivots).sum(axis=1).max()))
    block.search(topk_search.Side(x[::7], ids[::7], pivots))
    block.evaluated = 0
    for a in range(0, 2000, 100):
        block.search(topk_search.Side(x[a : a + 100], ids[a : a + 100], pivots))
    assert block.evaluated < 0.3 * 20 * 2000


def test_templates():
    t = Template("{% set a = 1 + 2 %}{% if a > 2 and x in 'abc' %}y{% elif true %}n{% endif %}{{ 'A' | lower ~ m['k'] }}{% for i in l %}{{ loop.index }}{% endfor %}{# no #}")
    assert "".join(p for p, _ in t.render(x="b", m={"k": 1}, l=[0, 0])) == "ya112"
    assert Template("{% if 1 == 2 %}x{% endif %}a{{ 'b' }}").tree == ("block", [("text", "ab")])
    for bad in ("{{ a.b( }}", "{% if x %}", "{{ x | nothing }}", "{{", "{% import os %}"):
        with pytest.raises(TemplateError):
            Template(bad)
    assert list(Template("{{ x.__class__ }}{{ x['upper'] }}").render(x="s")) == [("", False), ("", False)]
    rng = random.Random(4)
    e = Escaper(("<s>", "</s>", "[INST]", "[/INST]"))
    for _ in range(500):
        s = "".join(rng.choice(["<s>", "</s>", "[INST]", "\\", "[", "<", "/", "x", "\n"]) for _ in range(8))
        assert e.unescape(e.escape(s)) == s and not any(c in e.escape(s) for c in e.controls)
    assert formatter()[0].tree[0] == "block"


def test_chat_format(spark, tmp_path):
    rows = [(1, 0, "user", "hi <s> \\"), (1, 1, "assistant", "[INST]yo[/INST]"), (1, 1, "assistant", None), (2, None, None, "x"), (2, 5, "assistant", "é😀"), (None, 0, "user", "n")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(1)).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in queries.op4_chat_format(spark, str(tmp_path)).collect()}
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    said = "</s>[INST] ok [/INST]"
    assert (got[-1].n_turns, got[-1].turns_sha256, got[-1].loss_sha256, got[-1].loss_chars) == (2, h(f"user\n{said}\nassistant\n{said}\n"), h(said), len(said))
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_sha256) == (3, h("user\nhi <s> \\\nassistant\n\nassistant\n[INST]yo[/INST]\n"), h("[INST]yo[/INST]"))
    assert got[2].turns_sha256 == h("\nx\nassistant\né😀\n") and got[2].loss_chars == 2 and None in got


def brute_components(fps, ids):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 3):
            parent[find(i)] = find(int(j))
    least = defaultdict(lambda: 1 << 70)
    for i in range(len(fps)):
        least[find(i)] = min(least[find(i)], ids[i])
    return [least[find(i)] for i in range(len(fps))]


def fingerprint(t):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, docs, none):
    known = docs.where("doc_id is not null")
    text = {r.doc_id: r.text for r in known.collect()}

    got = {r.doc_id: r for r in simhash.simhash_components(known).collect()}
    ids = sorted(text)
    assert all(got[i].fp % (1 << 64) == fingerprint(text[i]) for i in ids)
    fps = np.array([got[i].fp for i in ids]).view(np.uint64)
    assert [got[i].component_id for i in ids] == brute_components(fps, ids)
    assert simhash.simhash_components(none).count() == 0 and simhash.simhash_components(docs).count() == docs.count()
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.where("doc_id is not null").collect()} == {i for i in ids if got[i].component_id == i}


def test_simhash_cuts_large_postings(spark):
    rng = random.Random(7)
    center = rng.getrandbits(64)
    fps = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(250)} | {rng.getrandbits(64) for _ in range(50)}
    signed = sorted(int(np.uint64(x).view(np.int64)) for x in fps)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for limit in (8192, 20):
        roots = {r.node: r.root for r in simhash.components(simhash.candidate_edges(df, limit)).collect()}
        want = brute_components(np.array(signed).view(np.uint64), signed)
        assert [roots.get(x, x) for x in signed] == want


@pytest.mark.parametrize("block_bytes", [2, 6, 1 << 20])
def test_token_scan(spark, tmp_path, block_bytes):
    files, want = [], []
    for k, docs_ in enumerate(([3, 0, 0, 5], [], [1], [0, 7])):
        ids = [i for n in docs_ for i in [9] * n + [token_scan.END]] + [8] * (k == 3)
        path = tmp_path / f"f{k}.tokens"
        np.array(ids, "<u2").tofile(path)
        files.append((str(path),))
        want += [(str(path), i, n, True) for i, n in enumerate(docs_)] + [(str(path), len(docs_), 1, False)] * (k == 3)
    got = token_scan.count_tokens(spark, spark.createDataFrame(files, "file string"), block_bytes=block_bytes)
    assert sorted(tuple(r) for r in got.select("file", "nth", "n_tokens", "closed").collect()) == sorted(want)


def test_token_counts(docs, none):
    encode = token_bytes(special_is_text=True)
    text = {r.doc_id: r.text for r in docs.collect()}
    got = token_scan.token_counts(docs.withColumn("file", F.lit("x")), block_bytes=4096).collect()
    assert len(got) == docs.count() and all(r.n_tokens == len(encode(text[r.doc_id] or "")) // 4 for r in got)
    assert token_scan.token_counts(none).count() == 0


def test_mixing(docs, none):
    rows = docs.collect()
    got = mix_sources(docs).collect()
    assert len(got) == len(rows) and mix_sources(none).count() == 0
    source = {r.doc_id: r.source for r in rows}
    sizes, taken, target, largest = Counter(), Counter(), {}, Counter()
    for r in got:
        s = source[r.doc_id]
        sizes[s] += r["size"]
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r["size"])
        assert r.taken <= 3 * r["size"]
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        assert target[s] <= 3 * sizes[s] + 1e-6 and abs(taken[s] - target[s]) <= largest[s]
    again = Counter((r.doc_id, r.taken) for r in mix_sources(docs.repartition(3)).collect())
    assert again == Counter((r.doc_id, r.taken) for r in got)
    want = Counter({r.doc_id: 0 for r in rows}) + Counter()
    for r in got:
        want[r.doc_id] += r.taken // r["size"] if r["size"] else 0
    worded = {r.doc_id for r in got if r["size"]}
    copies = Counter(r.doc_id for r in mixed(docs.withColumn("a.b", F.lit(1))).collect() if r.doc_id in worded)
    assert +copies == +want and mixed(docs).columns == docs.columns and mixed(none).count() == 0


def test_mixing_of_rows_that_share_ids(spark):
    """Targets hold to within a document where rows have no id, share one, or are equal."""
    rows = [(None, "w " * 4 + str(i % 25), "a") for i in range(50)] + [(7, "w " * 4 + str(i), "b") for i in range(50)] + [(8, "same text of five words", "c") for _ in range(50)] + [(9, None, None), (10, "", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mix_sources(df).collect()
    total, target = Counter(), {}
    for r in got:
        total[r.target] += r.taken
    assert len(got) == len(rows) and all(abs(t - n) <= 5 for t, n in total.items()) and sum(total.values()) == pytest.approx(750, abs=15)
    assert Counter((r.doc_id, r.taken) for r in mix_sources(df.repartition(2)).collect()) == Counter((r.doc_id, r.taken) for r in got)
    assert Counter(r.source for r in mixed(df).collect() if r.text)["c"] == sum(r.taken for r in got if r.doc_id == 8) // 5


def test_mixing_by_a_column_of_weights(spark):
    rows = [(i, "four words in all", f"s{i % 3}", 100.0 if i < 300 else [None, 0.0, -1.0, 0.01][i % 4]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, good double")
    got = {r.doc_id: r.taken for r in mix_sources(df, quality=F.col("good"), weights=(1, 1, 4)).collect()}
    heavy, light = (sum(got[i] for i in range(900) if i % 3 < 2 and (i < 300) == side) / (200 if side else 400) for side in (True, False))
    assert heavy > 1.9 * light


BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def brute_units(text, inside):
    """(start, end, words, is a line, normalised) of each unit."""
    out, at = [], 0
    for line in (text or "").split("\n"):
        w = [(at + m.start(), m[0].lower()) for m in re.finditer(rf"[\u4e00-\u9fff]|(?:(?!{BLANK}|[\u4e00-\u9fff]).)+", line, re.S)]
        keys = [sum(ord(c) * x for c, x in zip(x, (7, 131, 17, 211, 83, 401, 53, 307))) for _, x in w]
        own = []
        for i, (a, x) in enumerate(w):
            if i == 0 or inside and len(w) >= inside and (37 * keys[i] + (keys[i + 1] if i + 1 < len(w) else 0)) % 1009 < 126:
                own.append([a, a, 0, not inside or len(w) < inside, ""])
            own[-1][1:3], own[-1][4] = (a + len(x), own[-1][2] + 1), own[-1][4] + " " + x
        out += own
        at += len(line) + 1
    return out


def brute_repeats(rows, inside, min_run=20):
    """What each of the rows (id, text) loses; ids differ."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        runs, last = [], None
        for k, u in enumerate(brute_units(t, inside)):
            if u[4] in seen:
                if last != k - 1:
                    runs.append([])
                runs[-1].append(u)
                last = k
            seen.add(u[4])
        spans = []
        for run in runs:
            before = False
            for u in run:
                goes = u[3] or sum(x[2] for x in run) >= min_run
                if goes and before:
                    spans[-1] = (spans[-1][0], u[1], spans[-1][2] + u[2])
                elif goes:
                    spans.append((u[0], u[1], u[2]))
                before = goes
        out[i] = spans
    return out


def cut_out(text, spans):
    return "".join(text[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(text)], strict=True))


@pytest.mark.parametrize("inside", [0, 24])
def test_substring_dedup(spark, docs, none, inside):
    rows = [(r.doc_id, r.text) for r in docs.dropDuplicates(["doc_id"]).collect()]
    rows += [(100, rows[0][1]), (101, "Hot  LINE\n\tother\nhot line"), (102, "一二三四" * 9 + "\n" + "一二三四" * 9), (103, "a\u3000b\na b"), (104, LONG + "\n" + LONG)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in repeated_spans(df, inside=inside).collect()}
    want = brute_repeats(rows, inside)
    assert got == want and sum(map(bool, want.values())) > 12
    out = {r.doc_id: r for r in drop_repeats(df.withColumn("removed_spans", F.lit("mine")).withColumn("a.b", F.lit(1)), inside=inside).collect()}
    for i, t in rows:
        assert out[i].text == (t and cut_out(t, want[i])) and [tuple(s) for s in out[i].removed_spans_] == want[i] and (out[i].removed_spans, out[i]["a.b"]) == ("mine", 1)
    assert repeated_spans(none).count() == drop_repeats(none).count() == 0 and drop_repeats(docs).columns == [*docs.columns, "removed_spans"]


def test_substring_dedup_goes_by_rows_not_ids(spark):
    """Rows that share an id, or have none, and repeated rows: each line stays once, and a line that no other row has stays whole."""
    p, u = "this line is here twice", "only one row says this"
    rows = [(1, p), (7, p), (7, u), (None, p), (None, "another\nand more"), (None, p), (3, u + "!"), (3, u + "!"), (None, None), (7, "")]
    for parts_ in (1, 3):
        out = drop_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts_)).collect()
        assert Counter(x for r in out for x in (r.text or "").split("\n") if x) == Counter([p, u, u + "!", "another", "and more"])
        assert {r.doc_id for r in out if r.text == p} == {1} and len(out) == len(rows)
    strings = spark.createDataFrame([("b", p), ("a", p), (None, p)], "doc_id string, text string")
    assert {r.doc_id: r.text for r in drop_repeats(strings).collect()} == {"a": p, "b": "", None: ""}


def test_substring_dedup_of_long_runs_of_blanks(spark):
    began = time.time()
    for blank in " \t\n\u3000":
        assert len(batch_units(["x" + blank * 400_000 + "y"], 24)["k"]) == 1 + (blank == "\n")
    big = ("word " * 30 + "\n") * 20_000 + "tail " * 700_000
    units = batch_units(["first", big, "last"], 24)
    assert [tuple(u) for u in brute_units(big[:3000], 24)[:20]][0][:2] == (units["start"][1], units["end"][1]) and units["doc"][-1] == 2 and time.time() - began < 30


def test_passages_inside_lines_are_found_without_sentence_ends(spark):
    rng = random.Random(21)
    small = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    kinds = {
        "lower case": (small, " "), "capitalised": (lambda: small().capitalize(), " "), "one-word sentences": (lambda: small().upper() + "!", " "),
        "Hindi": (lambda: "".join(rng.choice("कखगघचछजझ") for _ in range(4)) + rng.choice(["", "", "", "।"]), " "),
        "Chinese": (lambda: chr(rng.randint(0x4E00, 0x9FA5)) + rng.choice(["", "", "", "。"]), ""), "Cyrillic": (lambda: "".join(rng.choice("абвгдежз") for _ in range(6)), " "),
    }
    rows, want = [], {}
    for word, gap in kinds.values():
        text = lambda n, w=word, g=gap: g.join(w() for _ in range(n))
        for _ in range(6):
            passage, k = text(90), len(rows)
            for at in (k, k + 1):
                before = text(rng.randint(3, 30)) + gap
                rows.append((at, before + passage + gap + text(rng.randint(3, 30))))
            want[k + 1] = (len(before), len(before) + len(passage))
    spans = {r.doc_id: r.spans for r in repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), inside=24).collect()}
    for i, (a, b) in want.items():
        assert sum(min(b, s.end) - max(a, s.start) for s in spans[i] if s.start < b and s.end > a) > 0.5 * (b - a), rows[i]
    alone = [(i, " ".join(small() for _ in range(120))) for i in range(50)]
    assert not any(r.spans for r in repeated_spans(spark.createDataFrame(alone, "doc_id long, text string"), inside=24).collect())


def test_line_dedup(docs, none):
    out = {r.doc_id: r for r in drop_repeated_lines(docs).collect()}
    rows = docs.collect()
    pages, held = Counter(r.source for r in rows), Counter()
    for r in rows:
        held.update({(r.source, x.strip(" ")) for x in (r.text or "").split("\n") if x.strip(" ")})
    for r in rows:
        gone = lambda x, s=r.source: held[s, x.strip(" ")] >= 2 and held[s, x.strip(" ")] > 0.1 * pages[s]
        want = None if r.text is None else "\n".join(x for x in r.text.split("\n") if not gone(x))
        assert out[r.doc_id].text == want
    assert drop_repeated_lines(none).count() == 0 and drop_repeated_lines(docs).columns == docs.columns
    assert drop_repeated_lines(docs.withColumn("a.b", F.lit(1)).withColumn("lines", F.lit("x"))).columns == [*docs.columns, "a.b", "lines"]


def brute_spans(t):
    out = []
    for k, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if k == 0 or (k == 1 and all(int(x) <= 255 for x in m[0].split("."))) or (k == 2 and 14 <= len(d) <= 19 and pii._luhn(d)) or (k == 3 and 10 <= len(d) <= 15):
                out.append((*m.span(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


@pytest.fixture(scope="module")
def pii_rows(spark, docs):
    more = [(200, "Mail bob@example.com or b[at]c[dot]de"), (200, "+1 212 555 0100"), (None, "10.0.0.1"), (None, "10.0.0.1"), (201, "x " * 300_000 + "a@b.cd " + "y " * 300_000)]
    return docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string")).withColumns({"base": F.lit(1), "spans": F.lit("s"), "a.b": F.lit(2)})


def test_pii_of_tables(pii_rows, none):
    want = Counter()
    for r in pii_rows.collect():
        base = brute_spans(r.text or "")
        want[r.doc_id, str([(a, b, pii.KINDS[k]) for a, b, k in base]), str([(a, b, pii.KINDS[k]) for a, b, k in sorted([*base, *pii.added_spans(r.text or "", base)], key=lambda s: (s[0], s[2]))])] += 1
    got = Counter((r.doc_id, str([tuple(s) for s in r.base]), str([tuple(s) for s in r.spans])) for r in pii.find_pii(pii_rows).collect())
    assert got == want and pii.find_pii(none).count() == 0


def test_pii_base():
    rng = random.Random(2)
    for k in range(8000):
        t = "".join(rng.choice("a1@. +-(5040") for _ in range(rng.randint(1, 45 if k % 20 else 900)))
        assert brute_spans(t) == pii.base_spans(t)


#: Disguised identifiers, each with its kind; what surrounds them is prose.
DISGUISED = {
    "email": [
        "john (at) example [dot] com", "john [at] example.com", "john{at}example{dot}com", "john<at>example<dot>com", "john at example dot com", "john dot doe at mail dot example dot org", "john@example dot com", "john AT example DOT com",
        "john -at- example -dot- com", "john_at_example_dot_com", "john*at*example*dot*com", "john at example.com", "john @ example.com", "john@example . com", "bob\t@\texample.com", "john(a)example.com", "john&#64;example&#46;com", "john&#x40;example.com",
        "jоhn@example.com", "john@exаmple.com", "jo\u200bhn@example.com", "john@exam\u00adple.com", "john＠example．com", "𝗃𝗈𝗁𝗇@example.com", "juan arroba ejemplo punto com", "jean arobase exemple point fr", "hans at beispiel punkt de", "john.doe at example dot co dot uk", "JOHN[AT]EXAMPLE[DOT]COM", "john %40 example%2ecom",
    ],
    "phone": [
        "plus one four one five five five five two six seven one", "plus one two 3 four 5 six 7 eight nine 0", "+1 (two one two) five five five 0 1 0 0", "plus 49 30 12345678", "+４９ ３０ １２３４５６７８", "+49 30 l2345678".replace(" l", " 1l"), "plus eins zwei drei vier fünf sechs sieben acht neun null",
        "más plus uno dos tres cuatro cinco seis siete ocho nueve cero"[4:], "+1\u200b212\u200b555\u200b0100", "+1 212‑555‑0100", "plus un deux trois quatre cinq six sept huit neuf zéro", "Plus One, Two, Three, Four, Five, Six, Seven, Eight, Nine, Zero",
    ],
    "card": [
        "four one one one one one one one one one one one one one one one", "4111 1111 1111 one one one one", "4111‑1111‑1111‑1111", "４１１１ １１１１ １１１１ １１１１", "four 1 one 1 one 1 one 1 one 1 one 1 one 1 one 1", "4111 11l1 1l11 1111", "4111\u200b1111\u200b1111\u200b1111",
        "cuatro uno uno uno uno uno uno uno uno uno uno uno uno uno uno uno", "four-one-one-one-one-one-one-one-one-one-one-one-one-one-one-one",
    ],
    "ip": ["192 dot 168 dot 0 dot 1", "one nine two dot one six eight dot one dot one", "192[.]168[.]0[.]1", "192(dot)168(dot)0(dot)1", "192.168.0[.]1", "１９２.１６８.０.１", "192․168․0․1", "192 punto 168 punto 0 punto 1", "192\u200b.168.0.1", "10 dot zero dot zero dot 1"],
}


def test_pii_recall_of_disguises():
    rng = random.Random(3)
    prose = lambda: " ".join("".join(rng.choice("aeimnorst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(3, 9)))
    found, every = Counter(), Counter()
    for kind, forms in DISGUISED.items():
        for form in forms:
            for before, after in ((prose() + ": ", ", " + prose()), ("(", ")"), (prose() + "\n", "\n" + prose()), ("", "")):
                text, at = before + form + after, len(before)
                base = pii.base_spans(text)
                spans = [(a, b) for a, b, k in base + pii.added_spans(text, base) if pii.KINDS[k] == kind]
                every[kind] += 1
                found[kind] += (at, at + len(form)) in spans
    assert all(found[k] >= 0.9 * every[k] for k in every), (found, every)


def test_pii_adds_nothing_to_clean_or_plain_texts():
    for t in (
        "look at example.com for more", "See the point. Then go at once", "we met at 10.30 and again at 11.15", "one two three, go", "a stay-at-home day and created_at_time.py", "un deux trois quatre", "mail bob@example.com. Then go", "bob@example.com point final", "he (at) home", "1 dot 5 and 2 point 5",
        "call +1 212 555 0100 one more time", "version 1.2.3.4 of it", "f(a) is a.b and {at} most",
    ):
        assert pii.added_spans(t, pii.base_spans(t)) == [], t
    rng = random.Random(8)
    signs = ["one", "Two", "zero", "sechs", "plus", "at", "dot", "punkt", "arroba", "@", ".", "[", ")", "<", "+49", "7", "192", "168", "bob", "com", "\t", " ", " ", " ", "-", "_", ",", "о", "\u200b", "é", "４", "&#64;", "İ"]
    for _ in range(20000):
        t = "".join(rng.choice(signs) + rng.choice(["", " "]) for _ in range(rng.randint(1, 24)))
        base = pii.base_spans(t)
        added = pii.added_spans(t, base)
        for kind in range(4):
            own = [(a, b) for a, b, k in added if k == kind]
            assert all(0 <= a < b <= len(t) for a, b in own) and all(x[1] <= y[0] for x, y in zip(own, own[1:], strict=False))
            assert not any(x <= a and b <= y for a, b in own for x, y, k in base if k == kind), t


def test_pii_takes_time_in_proportion_to_the_text():
    for unit in ("n", "one ", " ", "\t@ ", "at ", "dot ", "@", "a@", "1.", "plus ", "a dot ", "1o", "a-at-", "+1 ", "un, ", "at x.", "(at) ", "a@b dot ", "&#46;", "1 ", "_at_x_dot_", "\u200b", "о"):
        t = "user [at] x [dot] com " + unit * (200_000 // len(unit)) + "@b.com"
        began = time.process_time()
        pii.added_spans(t, pii.base_spans(t))
        assert time.process_time() - began < 5, unit


def brute_quality(rows):
    for r in rows:
        w = words(r["text"])
        failed = len(w) < 10 or 100 * repeated(w, 5) > 20 * len(w)
        if not failed and 100 * repeated(w, 10) <= 15 * len(w) and not repeated(w, 51):
            yield r


def brute_lines(rows):
    pages, held = Counter(r["source"] for r in rows), Counter()
    for r in rows:
        held.update({(r["source"], x.strip(" ")) for x in r["text"].split("\n") if x.strip(" ")})
    for r in rows:
        text = "\n".join(x for x in r["text"].split("\n") if not (held[r["source"], x.strip(" ")] >= 2 and held[r["source"], x.strip(" ")] > 0.1 * pages[r["source"]]))
        yield r | {"text": text, "n_chars": len(text)}


def brute_copies(rows):
    """How often the mix takes each row; no two rows have id and text in common."""
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    order = sorted(sizes, key=lambda x: (x is None, x))
    weight = {x: (5, 2, 1)[k % 3] for k, x in enumerate(order)}
    target, rest, total = {}, set(order), sum(sizes.values())
    while rest:
        share = {x: (total - sum(target.values())) * weight[x] / sum(weight[y] for y in rest) for x in rest}
        full = {x for x in rest if share[x] >= 3 * sizes[x]}
        target |= {x: 3 * sizes[x] for x in full} if full else share
        rest = rest - full if full else set()
    out = {}
    for x in order:
        own = []
        for r in rows:
            if r["source"] == x:
                n, symbols = len(words(r["text"])), sum(c in "#*$%&|<>" for c in r["text"])
                u = (int(hashlib.md5(f"{r['doc_id']}:{hashlib.md5(r['text'].encode()).hexdigest()}:0".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                own.append((-math.log(u) * (1 + 4 * symbols / max(n, 1)), n, r["doc_id"]))
        epochs = int(target[x] // sizes[x]) if sizes[x] else 0
        part, before, last = target[x] - epochs * sizes[x], 0, None
        for key, n, _ in sorted(own):
            last = key if before + n / 2 <= part else last
            before += n
        out |= {i: epochs + (part > 0 and last is not None and key <= last) for key, n, i in own}
    return out


def test_pipeline(spark, docs, tmp_path):
    """run() against the five stages in plain Python: every piece of every copy, each in its place."""
    import corpus_pipeline

    rng = random.Random(17)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    more = [(300 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(8, 90))) + (" #$" * (i % 3)), "en", f"s{i % 4}", 0) for i in range(60)]
    more += [(400 + i, more[i][1] + "\nadded", "en", "s1", 0) for i in range(8)] + [(500, more[9][1], "en", None, 0), (501, " ".join(rng.choice(vocabulary) for _ in range(5000)), "en", "s2", 0)]
    own = docs.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id is not null").dropDuplicates(["doc_id"])
    own.unionByName(spark.createDataFrame(more, own.schema)).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    rows = [r.asDict() for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()]
    stages = [list(brute_quality(rows))]
    stages.append(list(brute_lines(stages[-1])))
    fps = np.array([fingerprint(r["text"]) for r in stages[-1]], np.uint64)
    roots = brute_components(fps, [r["doc_id"] for r in stages[-1]])
    stages.append([r for r, root in zip(stages[-1], roots, strict=True) if r["doc_id"] == root])
    taken = brute_copies(stages[-1])
    stages.append([r for r in stages[-1] for _ in range(taken[r["doc_id"]])])
    key = lambda r: str(sorted(r.items(), key=str))
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], stages, strict=True):
        before, df = df, stage(spark, df, str(tmp_path)).cache()
        assert df.columns == before.columns, name
        assert Counter(key(r.asDict()) for r in df.collect()) == Counter(map(key, want)), name
    assert 10 < len(stages[2]) < len(stages[1]) < len(rows) and max(taken.values()) > 1
    encode, pieces = token_bytes(), Counter()
    for r in stages[-1]:
        ids = encode.exact.encode(r["text"], add_special_tokens=False).ids + [0]
        n = len(ids)
        cuts = [0, *range(n % 2048 or 2048, n + 1, 2048)] if n > 2048 else [0, n]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            pieces[r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == pieces
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    assert all(a == sum(n for _, n in sorted(x)[:k]) and a + n <= 2048 for x in places.values() for k, (a, n) in enumerate(sorted(x)))
    assert len(places) <= -(-sum(r.length for r in out) // 2048) + 1


def test_written_tables_can_be_released(spark, tmp_path):
    before = shared.mark(spark)
    shared.stash(spark.range(3), "a")
    kept = shared.stash(spark.range(4), "b")
    assert shared.mark(spark) == before + 2 and kept.inputFiles()
    shared.release(spark, before, but=1)
    assert shared.mark(spark) == before + 1 and kept.count() == 4
    size = spark.conf.get(shared.BATCH_BYTES)
    with shared.small_batches(spark):
        assert spark.conf.get(shared.BATCH_BYTES) == str(4 << 20)
    assert spark.conf.get(shared.BATCH_BYTES) == size


def test_chat_format_of_random_conversations(spark, tmp_path):
    rng = random.Random(31)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<", "[", "/", "s>", "hi", "é😀", "\n", " ", "<<SYS>>", "{{ x }}", "\u200b"]
    text = lambda: rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))])
    rows = [(c, t, rng.choice(["user", "assistant", "system", "odd"]), text()) for c in range(40) for t in range(rng.randint(1, 6))] + [(50, 0, "user", "x"), (50, 1, "assistant", "word </s> " * 60_000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"a.b": F.lit(1), "text_": F.lit("t")}).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    said = "</s>[INST] ok [/INST]"
    turns = defaultdict(list)
    for c, _, role, t in [*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)]:
        turns[c].append((role, t or ""))
    h = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {c: (len(x), h("".join(f"{r}\n{t}\n" for r, t in x)), sum(len(t) for r, t in x if r == "assistant"), h("".join(t for r, t in x if r == "assistant"))) for c, x in turns.items()}
    got = queries.op4_chat_format(spark, str(tmp_path)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want and len(got) == len(want)
    assert all(r.formatted_chars >= sum(len(t) for _, t in turns[r.conv_id]) for r in got)
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    assert [r.conv_id for r in queries.op4_chat_format(spark, str(tmp_path / "none")).collect()] == [-1]
