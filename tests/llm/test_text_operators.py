from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter
from math import comb

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from triangulum.llm import bpe_automaton, chosen_path, components, pii, url_rules
from triangulum.llm.queries import tokenizer_path

from compare import compare, duck
from .texts import odd_documents, words

SF = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            twice = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(d))]
            good = {
                "email": lambda: True,
                "ip": lambda: all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in twice) % 10 == 0,
                "phone": lambda: 9 <= len(d) <= 15,
            }[name]()
            if good:
                out.append((m.start(), kind, m.end(), name))
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(out))


@pytest.fixture(scope="module")
def scorer(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_base_spans(spark, scorer):
    draw = random.Random(4)
    signs = "0123456789" * 3 + " .-+()@%_ab,é\n😀"
    rows = [(i, "".join(draw.choice(signs) for _ in range(draw.randint(0, 60)))) for i in range(1500)]
    rows += [(9000, "a." * 9000 + "@" + "b." * 9000), (9001, "1 " * 20_000), (9002, "x@y.z_w@q.r 1.2.3.4.5.6.7.8")]
    docs = odd_documents(spark).select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    got = pii.find(docs, scorer).collect()
    want = Counter((i, hashlib.sha256(base_spans(t or "").encode()).hexdigest()) for i, t in texts.elements())
    assert Counter((r["doc_id"], r["base_sha256"]) for r in got) == want
    for r in got:
        counts = Counter(s.split(":")[0] for s in r["spans"].split(",") if s)
        assert all(counts[k] >= r[f"n_{k}"] for k in pii.KINDS)


def test_added_spans(spark):
    """Cards whose last digit is wrong look like cards, and a scorer that has seen few of them adds them."""
    draw = random.Random(1)
    rows = []
    for i in range(600):
        d = "4" + "".join(draw.choice("0123456789") for _ in range(14))
        check = next(c for c in "0123456789" if base_spans(d + c))
        good = d + check if i % 60 else d + str((int(check) + 1) % 10)
        rows.append((i, f"{words(i, 6)} {good} {words(-i - 1, 5)} 12.5 {words(i + 999, 3)} +1 (414) 555-{1000 + i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pii.find(docs, pii.fit(docs, precision=0.9)).collect()
    added = [r["doc_id"] for r in got if r["spans"].count("card") > r["n_card"]]
    assert added and all(i % 60 == 0 for i in added)


def test_redaction(spark, scorer):
    docs = odd_documents(spark)
    got = pii.redact(docs, scorer)
    assert got.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[7] == "mail <email> or <phone>, <card> from <ip>"
    assert texts[3] is None and texts[4] == ""
    empty = odd_documents(spark, empty=True)
    assert pii.redact(empty).count() == 0 and pii.find(empty).count() == 0


@pytest.mark.parametrize("threshold", [-9e9, 0.0])
def test_added_spans_by_brute_force(spark, threshold):
    """Every candidate from the threshold on that touches no base span is added, and no other one."""
    draw = random.Random(9)
    signs = "0123456789" * 3 + " .-+()@_ab,"
    rows = [(i, "".join(draw.choice(signs) for _ in range(draw.randint(0, 300)))) for i in range(300)]
    texts = spark.createDataFrame(rows, "doc_id long, _text string")
    scorer = pii.Scorer("IF(f.digits <= 9.0D, -1.0D, 1.0D)", (threshold,) * 4)
    found = pii.with_spans(pii.with_scores(texts, scorer.margin), scorer)
    got = {r["doc_id"]: [tuple(x) for x in r["_all"]] for r in found.collect()}
    plain = {k: v.replace("++", "+").replace("*+", "*").replace("}+", "}") for k, v in pii.GENERATORS.items()}
    added = 0
    for i, text in rows:
        base = [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in base_spans(text).split(",") if x)]
        want = set(base)
        for pattern, kinds in ((pii.MAIL_RUN, (0,)), (pii.NUMBER_RUN, (1, 2, 3))):
            for run in re.finditer(pattern, text):
                for k in kinds:
                    for m in re.finditer(plain[pii.KINDS[k]], run.group()):
                        start, stop = run.start() + m.start(), run.start() + m.end()
                        enough = threshold < -1 or sum(c.isdigit() for c in m.group()) > 9
                        if enough and not any(a < stop and start < b for a, _, b in base):
                            want.add((start, k, stop))
        assert got[i] == sorted(want), text
        added += len(want) - len(set(base))
    assert added > 20


def test_weak_labels_reach_beyond_the_base_rule(spark, scorer):
    """A cue word and a valid number make a label; the trees do not see the validity."""
    text = "tel. 414-555-7134 ; visa 4111.1111.1111.1111 ; part 414-555-7134 ; visa 4111.1111.1111.1112"
    rows = spark.createDataFrame([(text,)], "_text string")
    found = pii.with_candidates(rows).selectExpr("inline(_proposed)").collect()
    labels = {(pii.KINDS[r["kind"]], text[r["start"] : r["stop"]], r["start"]): r["label"] for r in found}
    assert labels["phone", "414-555-7134", 5] and labels["card", "4111.1111.1111.1111", 25]
    assert not labels["phone", "414-555-7134", 52] and not labels["card", "4111.1111.1111.1112", 72]
    assert "valid" not in pii.SEEN and "valid" not in scorer.margin


def test_sample_of_repeated_candidates(spark):
    """Copies of one text count once in the fit, and thresholds count all rows."""
    rows = [(i, "call +1 (414) 555-7134 or 10.0.0.1") for i in range(3000)] + [(5000 + i, f"part 414555{i:04d}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = pii.with_scores(docs.select(pii.text_of().alias("_text")), pii.fit_trees(docs))
    assert scored.selectExpr("inline(_scored)").filter("label").count() == 6000
    assert len(pii.thresholds_of(scored)) == 4


def test_many_matches_in_one_text(spark, scorer):
    """100,000 matches in one text take seconds, and redaction cuts each of them."""
    n = 50_000
    text = " and ".join(f"1.2.3.{i % 250} x{i}@y.z" for i in range(n))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    row = pii.find(docs, scorer).collect()[0]
    assert (row["n_ip"], row["n_email"]) == (n, n)
    assert row["base_sha256"] == hashlib.sha256(base_spans(text).encode()).hexdigest()
    assert pii.redact(docs, scorer).collect()[0]["text"] == " and ".join(["<ip> <email>"] * n)
    assert time.time() - began < 120


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def test_automaton_matches_the_library(library):
    mine, draw = bpe_automaton.tokenizer(tokenizer_path("word_bpe_49k.json")), random.Random(1)
    letters = [chr(c) for c in [*range(0, 0x250), 0x3A3, 0x130, 0x1E9E, 0x2028, 0x200B, 0x301, 0x1F600, 0x4E2D, 0x2167, 0xBD]]
    bits = ["<|endoftext|>", "<|startoftext|>", "'s", "'ll", " ", "aaaa", "the", "hello", "ing", "Σ"]
    texts = ["".join(draw.choice(draw.choice([letters, bits])) for _ in range(draw.randint(0, 40))) for _ in range(2000)]
    texts += ["".join(draw.choice("abehinostr") for _ in range(draw.randint(1, 30))) for _ in range(2000)]
    texts += [c * n for c in "aeiolsz" for n in range(1, 50)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        n, raw, decoded = mine.encode(text)
        assert (n, raw) == (len(ids), np.array(ids, "<u4").tobytes()), text
        assert decoded == mine.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("block", [1, 7, 64])
def test_blocks_of_a_text(monkeypatch, block):
    """Blocks end at white space and change neither ids nor the decoded text."""
    known = bpe_automaton.WordTokenizer(tokenizer_path("word_bpe_49k.json"))
    texts = ["", " ", "a", " \n a  b\x1cc \u2003d", "word " * 40, "x" * 300 + " y", "é\n\u2003ß Σ'll <|endoftext|>  x.", words(3, 200)]
    whole = [known.encode(t) for t in texts]
    monkeypatch.setattr(bpe_automaton, "BLOCK", block)
    monkeypatch.setattr(bpe_automaton, "KEPT_CHARS", 3)
    cut = bpe_automaton.WordTokenizer(tokenizer_path("word_bpe_49k.json"), memo=5)
    for text, (n, raw, decoded) in zip(texts, whole):
        assert cut.encode(text) == (n, raw, decoded)
        assert cut.digest(text) == (n, hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    assert all(len(piece) <= 3 for kept in (cut.memo, cut.older, cut.met) for piece in kept)


def test_memos_hold_plain_ids():
    """A piece costs one string of ids; labels come from the ids of a whole block."""
    known = bpe_automaton.WordTokenizer(tokenizer_path("word_bpe_49k.json"))
    n, raw, decoded = known.encode(text := "Über-words, and <|endoftext|>ends. " + words(5, 300))
    assert all(type(ids) is bytes and len(ids) % 4 == 0 for kept in (known.memo, known.met) for ids in kept.values())
    assert n * 4 == len(raw) and decoded == known.decode(np.frombuffer(raw, "<u4").tolist())
    assert known.encode(text) == (n, raw, decoded)


def test_gadgets_against_merging():
    """Random merge lists over three symbols: the automaton's path is what merging by rank gives."""
    draw = random.Random(5)
    for _ in range(60):
        tokens, merges = ["a", "b", "c"], []
        for _ in range(12):
            u, v = draw.choice(tokens), draw.choice(tokens)
            if u + v not in tokens:
                merges.append((u, v))
                tokens.append(u + v)
        automaton = bpe_automaton.Automaton({t: i for i, t in enumerate(tokens)}, merges)
        for _ in range(60):
            word = [draw.choice("abc") for _ in range(draw.randint(1, 14))]
            parts = list(word)
            for u, v in merges:
                at = 0
                while at < len(parts) - 1:
                    if (parts[at], parts[at + 1]) == (u, v):
                        parts[at : at + 2] = [u + v]
                    at += 1
            assert [tokens[i] for i in automaton.path("".join(word), len(word))] == parts


def test_bpe_of_odd_documents(spark, library):
    path = tokenizer_path("word_bpe_49k.json")
    docs = odd_documents(spark)
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        want[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), decoded] += 1
    assert Counter(map(tuple, bpe_automaton.digests(docs, path).collect())) == want
    assert bpe_automaton.digests(odd_documents(spark, empty=True), path).count() == 0
    full = bpe_automaton.encode_documents(docs, path).filter("doc_id = 6").first()
    assert full["ids"] == library.encode("a").ids and full["decoded"] == "a</w>"


def brute_classes(docs):
    sets = []
    for _, text in docs:
        w = [x for x in re.split("[ \t\n\x0b\x0c\r]+", text or "") if x]
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    n, up = len(docs), list(range(len(docs)))
    links = [0] * n

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(n):
        for b in range(a):
            both = len(sets[a] & sets[b])
            same = (docs[a][1] or "") == (docs[b][1] or "")
            if same or (both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9):
                links[a] += 1
                links[b] += 1
                up[root(a)] = root(b)
    least = {}
    for x, (doc_id, _) in enumerate(docs):
        r = root(x)
        least[r] = min((v for v in (least.get(r), doc_id) if v is not None), default=None)
    return Counter((d, least[root(x)], links[x]) for x, (d, _) in enumerate(docs)), len({root(x) for x in range(n)})


def near_copies():
    """Groups of near copies, some larger than a block, texts around the threshold, a frequent passage."""
    draw, rows, passage = random.Random(2), [], words(77, 30)
    for g in range(25):
        base = words(g, draw.randint(3, 90)).split()
        for _ in range(90 if g == 0 else draw.randint(1, 6)):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = words(draw.randrange(10**6), 1)
            rows.append(" ".join(copy) + (" " + passage if g % 3 == 0 else ""))
    return list(enumerate(rows))


def test_near_duplicates_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BLOCK_ROWS", 16)
    monkeypatch.setattr(chosen_path, "NODE_ROWS", 16)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, classes = brute_classes(rows)
    assert Counter(map(tuple, chosen_path.near_duplicates(docs).collect())) == want
    assert chosen_path.keep_one(docs).count() == classes


def test_texts_that_differ_in_white_space_only(spark):
    sizes = {g: 70 + 130 * g // 29 for g in range(30)}
    rows = [(1000 * g + k, words(g, 20) + " " * k) for g, n in sizes.items() for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter((i, i - i % 1000, sizes[i // 1000] - 1) for i, _ in rows)
    assert Counter(map(tuple, chosen_path.near_duplicates(docs).collect())) == want


def test_lone_pairs_in_large_nodes(spark, monkeypatch):
    """Sketches of three values each, so that all nodes must be split; 400 pairs equal in 4 of 5 positions."""
    monkeypatch.setattr(chosen_path, "NODE_ROWS", 16)
    draw = np.random.default_rng(3)
    lines = draw.integers(0, 3, (600, 64))
    near = np.where(draw.random((400, 64)) < 0.8, lines[:400], 3 + draw.integers(0, 3, (400, 64)))
    rows = [(f"{kind}{i}".encode(), line.tolist()) for kind, part in (("a", lines), ("b", near)) for i, line in enumerate(part)]
    sketches = spark.createDataFrame(rows, "key binary, sketch array<int>")
    nodes = chosen_path.leaves(sketches, 0.8, 1e-6)[0].select("node", "key")
    first, second = nodes.filter("key LIKE 'a%'"), nodes.filter("key LIKE 'b%'").withColumnRenamed("key", "other")
    met = first.join(second, "node").filter("substr(string(key), 2) = substr(string(other), 2)")
    assert met.select("key").distinct().count() == 400


def test_near_copies_cost_a_row_each(spark, monkeypatch):
    """1,500 lines around one centre and 300 that half agree with them; every alike pair ends up together."""
    draw = np.random.default_rng(4)
    base = draw.integers(0, 1 << 30, 64)
    lines = [np.where(draw.random(64) < share, draw.integers(0, 1 << 30, 64), base) for share in draw.uniform(0, 0.3, 1_500)]
    lines += [np.where(draw.random(64) < 0.5, draw.integers(0, 1 << 30, 64), base) for _ in range(300)]
    rows = [(f"{i:05}".encode(), line.tolist()) for i, line in enumerate(lines)]
    sketches = spark.createDataFrame(rows, "key binary, sketch array<int>")
    nodes, edges = chosen_path.leaves(sketches, 0.8, 1e-6)
    assert nodes.count() < 40 * len(rows)
    dealt = chosen_path.in_blocks(nodes.join(sketches, "key"), "node", chosen_path.block_count(F.col("size")))
    met = dealt.select("node", "_i", "_j", "_mine", "key", "sketch").mapInArrow(chosen_path._rough, "a binary, b binary")
    root = {int(r.node): r.root for r in components.components(met.unionByName(edges)).collect()}
    lines = np.array(lines)
    for x, line in enumerate(lines):
        for y in np.flatnonzero((lines == line).mean(axis=1) >= 0.8):
            assert x == y or root[x] == root[int(y)]


def test_texts_that_half_agree_are_not_split(spark):
    """3,000 lines that take each position's common value half the time; a split would hold five times their pairs."""
    draw = np.random.default_rng(5)
    base = draw.integers(0, 1 << 30, 64)
    lines = [np.where(draw.random(64) < 0.5, draw.integers(0, 1 << 30, 64), base) for _ in range(3_000)]
    lines += [np.where(draw.random(64) < 0.1, draw.integers(0, 1 << 30, 64), line) for line in lines[:100]]
    rows = [(f"{i:05}".encode(), line.tolist()) for i, line in enumerate(lines)]
    sketches = spark.createDataFrame(rows, "key binary, sketch array<int>")
    nodes, edges = chosen_path.leaves(sketches, 0.8, 1e-6)
    # What is returned reads written files: no level's joins run again in the plans that follow.
    assert not [df for df in (nodes, edges) if "Join" in df._jdf.queryExecution().executedPlan().toString()]
    nodes = nodes.select("node", "key")
    assert nodes.count() <= len(chosen_path.root_positions(0.8, 1e-6)) * len(rows)
    number = F.expr("int(string(key))")
    copies = nodes.filter(number >= 3_000).select("node", (number - 3_000).alias("copy"))
    met = copies.join(nodes.filter(number < 100).select("node", number.alias("copy")), ["node", "copy"])
    assert met.select("copy").distinct().count() == 100


def test_miss_of_the_splits():
    roots = len(chosen_path.root_positions(0.8, 1e-6))
    assert chosen_path.missed(0.8, roots, chosen_path.root_draws(0.8, 1e-6)) <= 1e-6 < chosen_path.missed(0.8, roots, 1)


def test_rough_share_keeps_pairs_at_the_threshold():
    least = next(n for n in range(65) if sum(comb(64, a) * 0.8**a * 0.2 ** (64 - a) for a in range(n + 1)) > 1e-6)
    lines = [[0] * 64, [0] * least + [1] * (64 - least)]
    columns = {"node": [1, 1], "_i": [0, 0], "_j": [0, 0], "_mine": [0, 0], "key": [b"a", b"b"], "sketch": lines}
    met = pa.Table.from_batches(chosen_path._rough(iter([pa.RecordBatch.from_pydict(columns)]))).to_pylist()
    assert met == [{"a": b"a", "b": b"b"}]


def test_near_duplicates_of_odd_documents(spark):
    docs = odd_documents(spark)
    want, classes = brute_classes([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert Counter(map(tuple, chosen_path.near_duplicates(docs).collect())) == want
    kept = chosen_path.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == classes
    empty = odd_documents(spark, empty=True)
    assert chosen_path.near_duplicates(empty).count() == 0 and chosen_path.keep_one(empty).count() == 0


def test_components(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(50)] + [(200, 200)] + [(100 + draw.randrange(60), 100 + draw.randrange(60)) for _ in range(40)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            up.setdefault(a, a)
            up.setdefault(b, b)
            x, y = sorted((root(a), root(b)))
            up[y] = x
    assert got == {x: root(x) for x in up}


def test_shingles_do_not_depend_on_blocks(monkeypatch):
    text = words(8, 400)
    whole = chosen_path.shingle_set(text)
    monkeypatch.setattr(chosen_path, "TEXT_BLOCK", 64)
    assert np.array_equal(chosen_path.shingle_set(text), whole) and len(whole) == 396


def test_url_rules(spark):
    draw = random.Random(3)
    labels = ["a", "b", "ab", "org", "com", "x"]
    hosts = [".".join(draw.choice(labels) for _ in range(draw.randint(1, 4))) for _ in range(60)]
    paths = ["/" + "/".join(draw.choice(["a", "ab", "b", ""]) for _ in range(draw.randint(0, 4))) for _ in range(40)] + [""]
    rules = [(draw.choice(hosts), draw.choice(paths), draw.choice(["allow", "block"])) for _ in range(150)]
    urls = [None, "", "nourl", "HTTP://A.Ab.ORG/x", "http://", "http://a b/c", "x://" + "a." * 3000 + "org/a"]
    urls += ["http://" + draw.choice(hosts) + draw.choice(paths) + draw.choice(["", "?q", "#f"]) for _ in range(800)]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, urls[-1], "h")], "page_id long, url string, host string")
    got = url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    want = Counter()
    for i, u in [*enumerate(urls), (None, urls[-1])]:
        m = re.match(r".*?://([^/?#]*)([^?#]*)", u or "", re.S)
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(a) + len(b), len(a), v, a + b) for a, b, v in rules if f".{host}".endswith(f".{a}") and path.startswith(b)]
        best = max(fits, default=(0, 0, "allow", None))
        want[i, host, path, best[3], best[2]] += 1
    assert Counter(map(tuple, got)) == want
    assert url_rules.judge(pages.limit(0), url_rules.rules_table(spark)).count() == 0
    no_rules = url_rules.rules_table(spark).limit(0)
    assert {r["rule"] for r in url_rules.judge(pages, no_rules, "block").collect()} == {None}


def test_url_rules_sql(spark):
    got = url_rules.judge(spark.read.parquet(f"{SF}/pages.parquet"), url_rules.rules_table(spark))
    assert compare(got, duck(SF), url_rules.ORACLE) == []
