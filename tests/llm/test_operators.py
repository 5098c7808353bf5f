"""The corpus operators against brute force, on a small fixture with planted cases."""

import base64
import collections
import gzip
import hashlib
import itertools
import math
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from matchloom.llm import bm25, bpe, decontaminate, langid, licenses, nearcopies, secrets, simhash, substrings, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(7)
VOCABULARY = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]


def prose(n, r):
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def fixture_texts():
    r = random.Random(3)
    passage, line = prose(60, r), prose(24, r)
    texts = [prose(r.randint(1, 120), r) for _ in range(60)]
    texts += [texts[3]] * 5 + [texts[10] + " tail"] + [f"{prose(9, r)} {passage} {prose(r.randint(0, 9), r)}" for _ in range(6)]
    texts += [f"{line}\n{prose(12, r)}\n{line}" for _ in range(8)]
    texts += [None, "", "   \n", "one", "one two", "an " * 300, "x" * 5000, "Ünïcode ß wörter 你好 " * 30, prose(6000, r)]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 20 else None, t, "en" if i % 2 else None, "src0", len(t or "")) for i, t in enumerate(fixture_texts())]
    rows += [rows[3], rows[5]]  # repeated rows
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- substrings


def brute_repeats(rows, width=20):
    key = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        w = (t or "").split()
        for s in range(len(w) - width + 1):
            k = tuple(w[s : s + width])
            first[k] = min(first.get(k, (key(i), s)), (key(i), s))
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        text = [x.decode() for x in w]
        for s in range(len(w) - width + 1):
            if first[tuple(text[s : s + width])] < (key(i), s):
                gone.update(range(s, s + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 3])
def test_substrings(docs, batches):
    expected = brute_repeats([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(substrings.remove_repeats(docs, batches=batches)) == expected
    assert sum(r[2] for r in expected) > 500


def test_substrings_hot_path(docs):
    expected = brute_repeats([(r.doc_id, r.text) for r in docs.collect()])
    for options in ({"hot_places": 2}, {"hot_places": 3, "most_hot": 50}, {"max_bits": 1 << 18}):
        assert rows_of(substrings.remove_repeats(docs, **options)) == expected


def test_substrings_empty_and_even_bits(empty, docs, spark):
    assert substrings.remove_repeats(empty).count() == 0
    index = substrings.FingerprintIndex(spark)
    high = [r["fp"] >> 62 for r in index.fingerprints(docs, "text").collect()]
    assert max(collections.Counter(high).values()) < 0.35 * len(high)  # slices of the filter are alike


def test_substrings_fanout_and_text(spark, docs):
    index = substrings.FingerprintIndex(spark, fanout=1)
    parts = docs.randomSplit([1.0] * 4, 1)
    for p in parts:
        index.ingest(p)
    assert len(index.runs) == 1
    merged = {r["fp"]: r["n"] for r in spark.table(index.runs[0][0]).collect()}
    direct = {r["fp"]: r["n"] for r in index.fingerprints(docs, "text").collect()}
    assert merged == direct
    index.close()
    got = substrings.remove_repeats(docs, with_text=True)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got.collect())


# --- secrets


def test_secrets_layers():
    inner = "password=hunter2hunter2"
    b64 = base64.b64encode(inner.encode()).decode()
    zipped = base64.b64encode(gzip.compress(f"x {b64} y".encode(), mtime=0)).decode()
    url = inner.replace("=", "%3D")
    uni = "".join(f"\\u{ord(c):04x}" for c in inner)
    for text, path in ((b64, "base64>assign"), (zipped, "base64+gzip>base64>assign"), (url, "url>assign"), (uni, "unicode>assign")):
        base, deeper = secrets.scan(f"see {text} end")
        assert (path, 4, 4 + len(text)) in deeper, (text, deeper)
        assert base == []
    assert secrets.redact(f"see {zipped} end") == "see [SECRET] end"


def test_secrets_base():
    text = "Token: abcdefgh12 api-key=short secret=abc\npasswd = 'ABCDEFGH=='"
    base, _ = secrets.scan(text)
    assert [k for k, *_ in base] == ["assign", "assign", "assign"][: len(base)]
    assert text[base[0][1] : base[0][2]] == "Token: abcdefgh12"
    # a failing match is consumed, not retried
    assert secrets.scan("password: token: abcdefghij")[0] == []
    assert secrets.scan("AKIA" + "A" * 11)[0] == [] and len(secrets.scan("AKIA" + "A" * 12)[0]) == 1
    assert len(secrets.scan("f" * 32)[0]) == 1 and secrets.scan("f" * 31)[0] == []
    assert secrets.scan("ſecret=abcdefghij")[0] == []


def test_secrets_bomb_and_cycle():
    bomb = base64.b64encode(gzip.compress(b"a" * 200_000)).decode()
    assert ("base64+gzip>bomb", 0, len(bomb)) in secrets.scan(bomb, 1000)[1]
    secrets.scan("%2525252541" * 50)  # ends


def test_secrets_frame(docs, empty):
    got = secrets.find_secrets(docs).collect()
    assert len(got) == docs.count() and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if not r.spans)
    assert secrets.find_secrets(empty).count() == 0
    assert secrets.redact_secrets(docs).columns == docs.columns


# --- language ID


def test_language(spark, empty):
    r = random.Random(1)
    words = {"aa": ["ka", "tu", "ri", "mola"], "bb": ["sch", "ung", "heit", "ver"], "cc": ["zione", "are", "lla", "per"]}
    say = lambda lang: " ".join("".join(r.choice(words[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(20, 80)))
    rows = [(i, say(lang), lang, "s", 1) for i, lang in enumerate(r.choice(list(words)) for _ in range(400))]
    rows += [(1000, None, "aa", "s", 0), (1001, "123 !!", "bb", "s", 0), (1002, "", None, None, None), (None, say("cc"), None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    found = {x.doc_id: x for x in langid.identify(df, langid.learn_dictionaries(df)).collect()}
    assert len(found) == len(rows)
    assert all(found[k].lang_pred == "und" and found[k].rejected for k in (1000, 1001, 1002))
    assert sum(found[i].lang_pred == lang for i, _, lang, *_ in rows[:400]) > 390
    assert found[None].lang_pred == "cc" and all(0 <= x.score <= 1 for x in found.values())
    kept = langid.keep_identified(df, langid.learn_dictionaries(df))
    assert kept.columns == df.columns and 380 < kept.count() < len(rows)
    assert langid.learn_dictionaries(empty) == {} and langid.identify(df, {}).filter("lang_pred <> 'und'").count() == 0


# --- toxicity


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton():
    r = random.Random(5)
    terms = ["".join(r.choice("abc") for _ in range(r.randint(3, 8))) for _ in range(40)]
    m = toxicity.Matcher(toxicity.Model(tuple((t, 1.0) for t in sorted(set(terms)))))
    for _ in range(2000):
        w = "".join(r.choice("abc") for _ in range(r.randint(1, 9)))
        best = min(((edit_distance(w, t), t) for t in terms))
        near = best[0] <= 1
        assert (m.trie.within(w) is not None) == near
        if near:
            assert m.trie.within(w) == (best[1], best[0])
        assert (m.known[w] is not None) == (best[0] <= toxicity.allowed(w))


def test_toxicity(spark, empty):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        w = [r.choice(VOCABULARY) for _ in range(40)]
        if toxic:
            for _ in range(4):
                w[r.randrange(40)] = r.choice(["grubbler", "snarkwit", "dolthead"])
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, int(toxic)))
    rows += [(9000, None, None, None, None), (9001, "", None, None, None), (9002, "you snarkwitt, you grubblr, dolthead!", None, None, None)]
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id long, toxic int")
    model = toxicity.learn(df, lab)
    got = {x.doc_id: x for x in toxicity.score(df, model).collect()}
    assert sum(got[i].predicted == t for i, t in labels) > 590
    assert got[9000].predicted == got[9001].predicted == 0 and got[9002].predicted == 1
    quoted = toxicity.Matcher(model).features('he said "dolthead" once')
    assert quoted[0] == 0 and quoted[2] > 0
    assert toxicity.score(df, toxicity.learn(df, lab.limit(0))).filter("predicted = 1").count() == 0
    assert toxicity.score(empty, model).count() == 0


def slow_features(model, text):
    """The features by edit distances to all terms, without trie, forms or memory."""
    low = (text or "").lower()
    found = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", low)]
    odds = dict(model.terms)
    exact = wrong = quoted = weight = 0.0
    opened = toxicity._quoted_stretches(low)
    for i, (w, a, b) in enumerate(found):
        near = min(((edit_distance(w, t), t) for t in odds), default=(9, ""))
        if near[0] > (1 if len(w) >= 4 and w not in model.clean else 0):
            continue
        around = [x for x, _, _ in found[max(0, i - 6) : i + 7]]
        if any(x <= a and b <= y for x, y in opened) or set(around) & toxicity.REPORTING:
            quoted += 1
            continue
        weight += odds[near[1]] * (1 if near[0] == 0 else 0.6)
        exact, wrong = exact + (near[0] == 0), wrong + (near[0] == 1)
    if exact + wrong + quoted == 0:
        return [0.0] * 6
    return [math.log1p(exact), math.log1p(wrong), math.log1p(quoted), math.log1p(100 * (exact + wrong) / len(found)), math.log1p(max(0.0, weight)), float(exact + wrong > 0)]


def test_toxicity_against_brute_force():
    r = random.Random(11)
    model = toxicity.Model((("grubbler", 4.0), ("idiot", 3.5), ("moron", 3.0), ("scum", 3.2)), (0.5, 0.4, -0.3, 0.7, 0.2, 1.0, -2.0), frozenset({"baron", "scam"}))
    m = toxicity.Matcher(model)
    pieces = ["you idi0t", "idot", "'moron'", "he said scum", "baron", "a scam", "grubler", '"grubbler here"', "mor0n", "maroon", "scums", "plain words", "x" * 50, "\n"]
    for _ in range(300):
        text = " ".join(r.choice(pieces) for _ in range(r.randint(0, 9)))
        x = m.features(text)
        assert all(abs(a - b) < 1e-12 for a, b in zip(x, slow_features(model, text), strict=True)), text
        z = sum(a * b for a, b in zip(model.weights, slow_features(model, text), strict=False)) + model.weights[-1]
        assert abs(m.score(text) - 1 / (1 + math.exp(-z))) < 1e-12
    assert m.features("you idi0t")[1] > 0 and m.features("the baron")[1] == 0
    many = '"a" ' * 50_000 + "idiot " * 50_000
    assert m.features(many)[0] > 10


# --- BPE


@pytest.fixture(scope="module")
def public():
    tiktoken = pytest.importorskip("tiktoken")
    P = pytest.importorskip("public_tokenizers")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(public):
    t = bpe.tokenizer(*bpe.default_vocabulary())
    r = random.Random(4)
    for alphabet in ("ab", "aab ", "abcdefghijklmnop", " \n\t a", "-= ", "é你 a😀", "0123456789 ", "aA1' s \x85\x1c ."):
        for n in (1, 7, 60, 700):
            for _ in range(6):
                x = "".join(r.choice(alphabet) for _ in range(n))
                assert t.encode(x) == public.encode_ordinary(x)
                assert t.decode(t.encode(x)) == x.encode() == t.decode_text(t.encode_text(x))
    for x in ("a" * 5001, "ab" * 3000, "<|endoftext|>", ""):
        assert t.encode(x) == public.encode_ordinary(x)


def test_bpe_frame(public, docs, empty):
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    want = sorted(((i, len(ids := public.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts), key=str)
    assert sorted(set(map(tuple, bpe.encode_digests(docs).collect())), key=str) == want
    back = bpe.decode(bpe.encode(docs)).select("text", "decoded").collect()
    assert all((r.text or "").encode() == bytes(r.decoded) for r in back)
    assert bpe.encode_digests(empty).count() == 0


# --- licenses


def test_licenses(docs, empty):
    text = "Licensed under the MIT License. Also Apache\nLicense; the GNU GPL, version 3 license; general-public license; mit  license"
    n, places, first, last, base, labels, score, found = licenses.scan(text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    starts = [i for i in range(len(words)) for p, _ in licenses.BASE if words[i : i + len(p.split())] == p.split()]
    assert (n, places, first, last) == (len(words), len(starts), min(starts), max(starts))
    assert base == "apache,gpl,mit" and "gpl-3.0" in labels and 0 < score <= 1
    assert not any(a is not b and b.start <= a.start and a.end <= b.end and b.priority > a.priority for a in found for b in found)
    assert licenses.scan("Licensed under the GNU Lesser General Public License v2.1")[5].split(",") == ["gpl", "lgpl-2.1"]
    assert licenses.scan(None)[:7] == (0, 0, None, None, "", "", 0.0)
    assert len(licenses.rules()) > 300
    assert licenses.find_licenses(docs).count() == docs.count() and licenses.find_licenses(empty).count() == 0


def test_license_gates_lose_nothing():
    r = random.Random(6)
    bits = ["licensed under the ", "spdx-license-identifier: ", "license: ", "mit", "apache 2.0", "gnu gpl", " license", "cc by-sa 4.0", "gpl v3", "see the ", "mozilla public", " under ", "lgpl 2.1"]
    for _ in range(300):
        t = "".join(r.choice(bits) for _ in range(5)).lower()
        hit = {x.label for x in licenses.rules() if x.pattern.search(t)}
        gated = {x.label for x in licenses.rules() if all(any(w in t for w in g) for g in x.gate) and x.pattern.search(t)}
        assert hit == gated


# --- search


def test_search(docs, empty):
    import math

    rows = [(r.doc_id, bm25.words(r.text)) for r in docs.collect()]
    n, mean = len(rows), sum(len(w) for _, w in rows) / len(rows)
    df = collections.Counter(t for _, w in rows for t in set(w))
    idf = {t: math.log(1 + (n - c + 0.5) / (c + 0.5)) for t, c in df.items()}
    queries = docs.filter("doc_id % 7 = 0")
    for block_terms in (50, 10**6):
        want = []
        for q in {r.doc_id for r in queries.collect()}:
            chosen = {t for i, w in rows if i == q for t in w}
            scored = []
            for i, w in rows:
                c = collections.Counter(w)
                s = round(sum(idf[t] * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t in sorted(chosen) if c[t]), 6)
                if s > 0:
                    scored.append((-s, i is None, i or 0, i))
            want += [(q, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:10])]
        got = bm25.search(docs, queries, shard_postings=700, block_terms=block_terms)
        strip = lambda xs: sorted([(a, b, d) for a, b, c, d in xs], key=str)  # noqa: E731  repeated rows tie
        assert [x[:2] for x in strip(map(tuple, got.collect()))] == [x[:2] for x in strip(want)]
        for x, y in zip(strip(map(tuple, got.collect())), strip(want), strict=True):
            assert abs(x[2] - y[2]) < 2e-6
    assert bm25.search(docs, empty).count() == 0 and bm25.search(empty, docs).count() == 0


def test_search_skips(spark):
    """WAND gives what scoring every posting gives, and skips stretches that cannot hold a result."""
    r = random.Random(21)
    topics = [[f"t{k}w{i}" for i in range(150)] for k in range(12)]
    texts = [" ".join([f"h{i % 12}"] * 9 + r.choices(topics[i % 12], k=40) + r.choices([f"c{j}" for j in range(20)], k=40)) for i in range(3000)]
    index = bm25.build_shards(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), 10**9, "doc_id", "text").collect()
    mean = sum(len(t.split()) for t in texts) / len(texts)
    shard = bm25.Shard(*map(bytes, index[0]), mean)
    df = collections.Counter(t for x in texts for t in set(x.split()))
    tf = [collections.Counter(x.split()) for x in texts]
    for q in range(0, 60, 7):
        terms = sorted(set(texts[q].split()))
        idf = [math.log(1 + (3000 - df[t] + 0.5) / (df[t] + 0.5)) for t in terms]
        want = sorted((-round(sum(w * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for t, w in zip(terms, idf, strict=True) if c[t]), 6), i) for i, c in enumerate(tf))[:10]
        (got,) = shard.top([([t.encode() for t in terms], idf)], 10)
        assert [i for i, _ in got] == [i for _, i in want] and all(abs(s + w) < 2e-6 for (_, s), (w, _) in zip(got, want, strict=True))
    assert shard.visited < 0.6 * shard.possible


# --- SimHash


def brute_fingerprint(text, size=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    got = {(r.doc_id, r.fingerprint) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(i, f"{f:016x}") for i, f in fps}
    assert simhash.near_duplicates(docs).count() == len(rows) and simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(docs).columns == docs.columns


def test_simhash_links(spark):
    r = random.Random(9)
    fps = {r.getrandbits(64) for _ in range(30)} | {0, (1 << 64) - 1, 1 << 63}
    for _ in range(5):
        for f in list(fps)[:60]:
            fps.add(f ^ (1 << r.randrange(64)) ^ (r.choice([0, 1]) << r.randrange(64)))
    fps = sorted(fps)
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in itertools.combinations(fps, 2):
        if bin(a ^ b).count("1") <= 2:
            parent[root(a)] = root(b)
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    rows = [(k, signed(f)) for k, f in enumerate([*fps, *fps[:10]])]
    got = {x.doc_id: x.component_id for x in simhash.group(spark.createDataFrame(rows, "doc_id long, fp long")).collect()}
    groups = collections.defaultdict(list)
    for k, f in enumerate([*fps, *fps[:10]]):
        groups[root(f)].append(k)
    assert got == {k: min(g) for g in groups.values() for k in g}


# --- WARC


def test_warc(spark):
    page = "<html>" + "é" * 80 + "</html>"
    rows = [(3, "http://a/\r\nx", page), (1, None, page), (2, "http://b", page), (7, "u", "short"), (8, "u", "short"), (9, "u", None), (10, "u", ""), (11, "v", "z" * 100), (12, "v", "z" * 99), (13, "v", "z" * 99), (11, "v", "z" * 100), (None, "n", page), (5, "big", "q\r\n\r\n" * 40_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    first = {}
    for i, _, h in rows:
        if h and len(h.encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        revisit = h in first and first[h] != i
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None))
    assert rows_of(warc.round_trip(df)) == sorted(want, key=str)
    index = warc.write_archives(df)
    some = index.filter("page_id in (1, 5, 12)")
    got = {r.page_id: bytes(r.payload) for r in warc.read_records(some, gap=0, most=1000).collect()}
    assert got == {i: (h or "").encode() for i, _, h in rows if i in (1, 5, 12)}
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_ids_and_archives(spark, tmp_path):
    """Ids of text with line breaks come back; an archive is a row of whole records that begins with warcinfo."""
    ids = ["a\r\nX-Page-Id: b", "50%", "é/ü", "", "x" * 300]
    df = spark.createDataFrame([(i, f"http://h/{k}", "same " * 40 if k < 3 else f"p{k}") for k, i in enumerate(ids)], "page_id string, url string, html string").coalesce(1)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(df).collect()}
    first = min(ids[:3])
    assert got == {i: ("revisit", first) if i in ids[:3] and i != first else ("response", None) for i in ids}
    index = warc.write_archives(df, folder=f"file://{tmp_path}/w")
    (file,) = (tmp_path / "w").iterdir()
    data, records = gzip.decompress(file.read_bytes()), []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        records.append((re.search(rb"WARC-Type: (\w+)", head)[1], re.search(rb"WARC-Block-Digest: sha256:(\w+)", head), rest[:size]))
        assert rest[size : size + 4] == b"\r\n\r\n"
        data = rest[size + 4 :]
    assert records[0][0] == b"warcinfo" and len(records) == 6 == index.count() + 1
    assert all(hashlib.sha256(block).hexdigest().encode() == digest[1] for _, digest, block in records[1:])
    parts = warc.read_records(index)
    assert sorted(len(r.payload or b"") for r in parts.collect()) == sorted([200, 0, 0, 2, 2])


# --- decontamination


def test_leaks(spark, empty):
    r = random.Random(8)
    items = [(i, prose(r.randint(5, 40), r)) for i in range(30)] + [(98, "two words"), (99, None)]
    rows = []
    for i in range(150):
        text = prose(r.randint(0, 80), r)
        if i % 4 == 0:
            leak = items[r.randrange(30)][1].split()
            for _ in range(r.randrange(3)):
                leak[r.randrange(len(leak))] = "changed"
            text = f"{text} {' '.join(leak).upper()}, {prose(r.randint(0, 30), r)}"
        rows.append((i, text, None, None, None))
    rows += [(500, None, "x", "y", 1), (501, "", None, None, None), (None, items[0][1], None, None, None), rows[0]]
    docs = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")

    def grams(text):
        w = [x for x in re.sub(r"[^a-z0-9]+", " ", (text or "").lower()).split()]
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    want = {}
    for i, text, *_ in rows:
        g = grams(text)
        for item, itext in items:
            b = grams(itext)
            if not b or not g:
                continue
            cb = collections.Counter(b)
            for s in range(max(1, len(g) - len(b) + 1)):
                ca = collections.Counter(g[s : s + len(b)])
                sim = sum((ca & cb).values()) / sum((ca | cb).values())
                if sim >= 0.8:
                    want[i, item] = max(want.get((i, item), 0), sim)
    got = {(x.doc_id, x.item_id): x.similarity for x in decontaminate.find_leaks(docs, bench).collect()}
    assert len(want) > 15 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} == {x[0] for x in rows} - {k[0] for k in want}
    assert decontaminate.find_leaks(empty, bench).count() == 0 and decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def test_native_plan(spark, docs):
    plan = decontaminate.find_leaks(docs, docs.selectExpr("doc_id item_id", "text"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


CLASHES = "fp h start component lang_pred score words item_id d tk prefix bits n shared root rank term query_id id terms k shingles size pos at payload digest file offset length path kind label x".split()


def everything(spark, docs):
    """Each operator on one table, by name."""
    bench = spark.createDataFrame([(1, "one two three four five six seven"), (2, None), (3, "short")], "item_id long, text string")
    labels = docs.select("doc_id", (F.length("text") % 2).alias("toxic"))
    pages = docs.select("*", F.col("doc_id").alias("page_id"), F.lit("http://h").alias("url"), F.col("text").alias("html"))
    return {
        "substrings": lambda: substrings.remove_repeats(docs),
        "secrets": lambda: secrets.find_secrets(docs),
        "masked": lambda: secrets.redact_secrets(docs).select("doc_id", "text"),
        "langid": lambda: langid.identify(docs, langid.learn_dictionaries(docs)),
        "toxicity": lambda: toxicity.score(docs, toxicity.learn(docs, labels)),
        "bpe": lambda: bpe.encode_digests(docs),
        "licenses": lambda: licenses.find_licenses(docs).drop("detections"),
        "bm25": lambda: bm25.search(docs, docs.filter("doc_id % 9 = 0")).drop("doc_id"),
        "simhash": lambda: simhash.near_duplicates(docs),
        "nearcopies": lambda: nearcopies.keep_one(docs).select("doc_id", "text"),
        "warc": lambda: warc.round_trip(pages),
        "leaks": lambda: decontaminate.find_leaks(docs, bench),
        "clean": lambda: decontaminate.without_leaks(docs, bench).select("doc_id", "text"),
    }


def test_clashing_columns(spark, docs):
    odd = docs
    for c in CLASHES:
        odd = odd.withColumn(c, F.lit(1))
    plain, clashing = everything(spark, docs), everything(spark, odd)
    for name in plain:
        assert rows_of(clashing[name]()) == rows_of(plain[name]()), name


def test_empty_tables(spark, empty):
    for name, run in everything(spark, empty).items():
        assert run().count() == 0, name
