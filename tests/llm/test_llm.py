"""The training-data operators against brute force, with nulls, empty and very long texts, ties and repeats."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gleanwork.llm import chat, components, exact_dedup, line_dedup, minhash, mixing, pieces, quality_classifier, quality_rules, token_files, url_filter
from gleanwork.llm import queries as llm_queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, n bigint, kept boolean, place string"


def docs_of(spark, rows):
    """Documents with further columns whose names clash with working columns."""
    full = [(i, t, "en", s, len(t) if t is not None else None, 7, False, "x") for i, t, s in rows]
    return spark.createDataFrame(full, DDL).repartition(3)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    base = [prose(rng, 60) for _ in range(6)]
    rows = [(i, base[i % 6], f"s{i % 3}") for i in range(18)]
    for i in range(18, 40):
        words = base[i % 6].split()
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), None if i % 5 == 0 else f"s{i % 3}"))
    rows += [(40, None, "s0"), (41, "", "s0"), (42, " \n\t ", None), (43, "Ab c", "s1"), (44, "aB  c", "s1"), (45, prose(rng, 20_000), "s2")]
    return rows + [(None, "no id here", None), (5, base[5], "s2")]


def test_exact_dedup(spark, corpus):
    for share in (1000, 5):
        got = exact_dedup.exact_dedup(docs_of(spark, corpus), share=share).collect()
        groups = defaultdict(list)
        for i, t, _ in corpus:
            groups[t or ""].append(i)
        assert len(got) == len(corpus)
        kept = Counter()
        for r in got:
            text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
            assert r.group_size == len(groups[text])
            assert r.keep_id == max((i for i in groups[text] if i is not None), default=None)
            kept[text] += r.kept
        assert set(kept.values()) == {1}
        left = exact_dedup.drop_exact_copies(docs_of(spark, corpus), share=share)
        assert left.columns == DDL.replace(" bigint", "").replace(" string", "").replace(" boolean", "").split(", ")
        assert sorted((r.text or "") for r in left.collect()) == sorted(groups)
    assert exact_dedup.exact_dedup(docs_of(spark, [])).count() == 0


def base_rules(text):
    words = WORD.findall(text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return n, sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_quality_rules(spark, corpus):
    rng = random.Random(8)
    menu = "Home | News | Sport | Shop | About"
    clean = "\n".join(prose(rng, 30) + "." for _ in range(4))
    rows = [*corpus, (60, clean, "a"), (61, clean + "\n" + menu, "a"), (62, "\n".join([menu] * 20), "a"), (63, "a a a a " * 40, "a"),
            (64, clean + "\nAll rights reserved.\n" + clean, "a"), (65, "x*** y### " * 60 + "\n" + "good words here. " * 3, "a")]
    got = {(r.doc_id, r.text): r.quality for r in quality_rules.quality_rules(docs_of(spark, rows)).collect()}
    for i, text, _ in rows:
        q = got[(i, text)]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == base_rules(text)
        assert not (q.base_failed and q.kept)
    by_id = {i: q for (i, _), q in got.items()}
    assert by_id[60].kept and by_id[60].cleaned_text == clean
    assert by_id[61].kept and by_id[61].cleaned_text == clean and by_id[61].n_removed_lines == 1
    assert by_id[64].cleaned_text == clean + "\n" + clean
    assert not by_id[62].kept and not by_id[63].kept and not by_id[65].kept


def test_cascade_is_exact(spark):
    universe = spark.range(3000).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % 5 == 0).alias("listed"))
    levels = url_filter.build_cascade(universe)
    assert len(levels) > 1
    assert universe.where(url_filter.listed_by(levels, F.col("key")) != F.col("listed")).count() == 0
    assert universe.where(url_filter.listed_by(url_filter.build_cascade(universe.where("not listed")), F.col("key"))).where("not listed").count() == 0


def test_urls(spark):
    cases = [("http://A.Example.NET/en/x?y", "a.example.net", "/en/x", "example.net/en/", "allow"), ("https://b.net/", "b.net", "/", "net/", "block"),
             ("https://b.net", "b.net", "", None, "allow"), ("x://casino.org/fr/#a", "casino.org", "/fr/", "org/fr/", "allow"),
             ("x://casino.org/de", "casino.org", "/de", None, "block"), (None, "", "", None, "allow"), ("nothing", "", "", None, "allow"),
             ("http://notexample.com/de/a", "notexample.com", "/de/a", None, "allow"), ("a://b://c/d", "b:", "//c/d", None, "allow"),
             ("http://É.com?x/", "É.com", "", None, "allow")]
    pages = spark.createDataFrame([(i, c[0], "h", "r") for i, c in enumerate(cases)], "page_id bigint, url string, host string, rule string")
    for most in (url_filter.MAX_KEYS, 0):
        got = url_filter.filter_urls(pages, url_filter.is_spam_host(F.col("host")), max_keys=most).orderBy("page_id").collect()
        assert [(r.url, r.host, r.path, r.rule, r.verdict) for r in got] == cases
    assert url_filter.filter_urls(pages.limit(0), url_filter.is_spam_host(F.col("host"))).count() == 0


def shingle_set(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def components_of(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def test_near_duplicates(spark, corpus):
    got = minhash.near_duplicates(docs_of(spark, corpus)).collect()
    sets = [shingle_set(t) for _, t, _ in corpus]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    roots = components_of(len(sets), links)
    low = {r: min((corpus[i][0] for i in range(len(sets)) if roots[i] == r and corpus[i][0] is not None), default=None) for r in roots}
    want = Counter((corpus[i][0], len(sets[i]), low[roots[i]]) for i in range(len(sets)))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert all(r.kept == (r.component_id is None or r.doc_id == r.component_id) for r in got)
    assert minhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(300, 300)]
    want = components_of(301, [e for e in edges if e[0] != e[1]])
    got = components.components(spark.createDataFrame(edges + edges[:5], "a bigint, b bigint")).collect()
    assert {r.item: r.label for r in got} == {i: want[i] for e in edges if e[0] != e[1] for i in e}


def test_hot_buckets_lose_no_link(spark):
    values = {i: (i * 37) % 400 for i in range(150)}
    members = spark.range(150).select(F.lit(1).cast("long").alias("bucket"), F.col("id").alias("item"))

    def verify(pairs):
        far = F.abs((F.col("a") * 37) % 400 - (F.col("b") * 37) % 400)
        return pairs.where(far <= 3).select("a", "b")

    want = components_of(150, [(i, j) for i in values for j in values if j < i and abs(values[i] - values[j]) <= 3])
    got = {r.item: r.label for r in components.linked(members, verify).collect()}
    assert [got.get(i, i) for i in range(150)] == want


def test_mixing(spark, corpus):
    rng = random.Random(1)
    rows = [*corpus, *[(100 + i, prose(rng, rng.randint(1, 30)), rng.choice(["s0", "s1", "s2", "s3", None])) for i in range(400)]]
    got = mixing.mix_sources(docs_of(spark, rows), chunk_rows=20).collect()
    again = mixing.mix_sources(docs_of(spark, rows[::-1]), chunk_rows=20).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again)) and len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    open_, target, rest = set(order), {}, sum(sizes.values())
    while True:
        per = rest / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * per > 3 * sizes[s]}
        if not above:
            break
        for s in above:
            target[s] = 3.0 * sizes[s]
            rest -= 3 * sizes[s]
        open_ -= above
    target.update((s, weight[s] * per) for s in open_)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in order:
        if s != "s2":  # holds one text of 20,000 words
            assert taken[s] == pytest.approx(target[s], abs=70)
    mixed = mixing.mix_documents(docs_of(spark, rows), chunk_rows=20)
    assert mixed.count() == sum(r.copies for r in got) and mixed.columns[:2] == ["doc_id", "text"]
    assert mixing.mix_sources(docs_of(spark, [])).count() == 0


def test_mixing_tells_rows_of_one_id_by_their_text(spark):
    rng = random.Random(77)
    rows = [(rng.choice([None, 1, 2]), " ".join(rng.choice("abcdefgh") for _ in range(3)), f"s{i % 3}") for i in range(300)]
    one, two = (docs_of(spark, x) for x in (rows, rng.sample(rows, len(rows))))
    verdicts = [Counter(map(tuple, mixing.mix_sources(x, chunk_rows=16).collect())) for x in (one, two.repartition(5))]
    texts = [Counter((r.doc_id, r.text, r.source) for r in mixing.mix_documents(x, chunk_rows=16).collect()) for x in (one, two.repartition(5))]
    assert verdicts[0] == verdicts[1] and texts[0] == texts[1]


def test_pivot_keeps_words_and_expectations():
    sums = np.zeros(2)
    for i in range(4000):
        p, q = mixing.pivot(i, 0.3, 10, i + 1, 0.6, 25, "t")
        assert p * 10 + q * 25 == pytest.approx(18.0) and (p in (0.0, 1.0) or q in (0.0, 1.0))
        sums += (p, q)
    assert sums / 4000 == pytest.approx([0.3, 0.6], abs=0.03)


ODD = ["", " ", "  a", "a  b", "a \n b", "\n\n\nx y", "a\tb c\t d", "it's I'll  '", "x.\ny, z. ...\n\n end ", "a\x1c b", "<|endoftext|> hi", "漢字 かな。\n次 ",
       "🙂🙂 a. b.", "a\0 b", "x\r\ny \r\n z", "a ", "   ", "▁x", "x" * 300]


def test_byte_encoder_is_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(list(" \n\t.,'aábZ1 é 漢\x85-sdmt")) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for text, got in zip(texts, token_files.ByteEncoder(path).encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_files(spark, corpus, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [r for r in corpus if r[0] is not None][:-1]
    path = str(tmp_path / "files")
    token_files.write_token_files(docs_of(spark, rows), path, public_tokenizers.path("byte_bpe_50k.json"), text_per_file=20_000)
    files = token_files.read_token_files(spark, path)
    got = {r.doc_id: r for r in token_files.starts(files).join(token_files.checksums(files), ["file", "row"]).collect()}
    start = 0
    for i, text, _ in sorted(rows):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert files.select("file").distinct().count() > 1
    empty = str(tmp_path / "empty")
    token_files.write_token_files(docs_of(spark, []), empty, public_tokenizers.path("byte_bpe_50k.json"))
    assert token_files.read_token_files(spark, empty).count() == 0


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(public_tokenizers.path("piece_bpe_32k.model"), samples=3)


def test_pieces_are_the_library_and_come_back(codec):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(list(" \n▁abtheroi,.é漢🙂\0")) for _ in range(rng.randint(0, 20))) for _ in range(800)]
    cut = [pieces.words_of(t) for t in texts]
    for text, ids, drawn in zip(texts, codec.encode(cut), codec.sample(cut, list(range(len(texts))))):
        assert ids.tolist() == codec.processor.encode(text), repr(text)
        assert len({tuple(r["ids"].tolist()) for r in drawn}) == len(drawn)
        assert all(codec.decode([r["ids"]])[0] == text.replace("▁", " ") for r in drawn)
        assert [r["perturbed"] for r in drawn] == sorted((r["perturbed"] for r in drawn), reverse=True)


def test_samples_follow_gumbel_top_k(codec):
    net = codec.lattices

    def ways(word):
        if not word:
            return [((), 0.0)]
        return [((net.pieces[word[:j]], *rest), net.log_weight[net.pieces[word[:j]]] + w)
                for j in range(1, len(word) + 1) if word[:j] in net.pieces for rest, w in ways(word[j:])]

    full = {a + b: u + v for a, u in ways("▁the") for b, v in ways("▁at")}
    total = math.log(sum(map(math.exp, full.values())))
    paths = list(full)
    log_p = np.array([full[p] - total for p in paths])
    n = 6000
    noisy = np.random.default_rng(0).gumbel(size=(n, len(paths))) + log_p
    want = np.bincount(np.argsort(-noisy, axis=1)[:, :3].ravel(), minlength=len(paths)) / n
    seen, weights = Counter(), Counter()
    for drawn in codec.sample([pieces.words_of("the at")] * n, list(range(n))):
        for r in drawn:
            path = tuple(r["ids"].tolist())
            assert r["log_prob"] == pytest.approx(full[path] - total)
            seen[path] += 1
            weights[path] += math.exp(r["log_weight"])
    for path, p, share in zip(paths, np.exp(log_p), want):
        assert seen[path] / n == pytest.approx(share, abs=0.03)
        assert weights[path] / n == pytest.approx(p, abs=0.03)


def test_encode_and_sample(spark, corpus):
    model = public_tokenizers.path("piece_bpe_32k.model")
    made = pieces.encode_and_sample(docs_of(spark, corpus), model)
    rows = made.collect()
    again = pieces.encode_and_sample(docs_of(spark, corpus[::-1]), model).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == len(corpus)
    assert all(r.round_trip for r in rows)
    back = pieces.decode_ids(made, model).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t or "") for i, t, _ in corpus)
    assert pieces.encode_and_sample(docs_of(spark, []), model).count() == 0


def test_query_gives_the_ids_it_makes(spark, corpus, tmp_path):
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = docs_of(spark, [*corpus[:40], (None, "漢 a🙂", None), (7, None, None)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    made = llm_queries.op2_sentencepiece(spark, str(tmp_path))
    rows = made.collect()
    for held in [*rows, *(x for r in rows for x in r.samples)]:
        assert (held.n_pieces, held.ids_crc32) == (len(held.ids), zlib.crc32(np.array(held.ids, "<u4").tobytes()))
    plain = pieces.encode_and_sample(docs, model).collect()
    assert Counter(str((r.doc_id, r.ids, [x.ids for x in r.samples])) for r in rows) == Counter(str((r.doc_id, r.ids, [x.ids for x in r.samples])) for r in plain)
    pulled = made.select("doc_id", "ids", F.explode("samples.ids").alias("drawn"))
    back, again = (Counter(map(str, pieces.decode_ids(pulled, model, ids=c).collect())) for c in ("ids", "drawn"))
    assert back == again and len(rows) == docs.count()


def edits(a, b):
    row = list(range(len(a) + 1))
    for i, y in enumerate(b):
        new = [i + 1]
        for j, x in enumerate(a):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def changed(rng, text, most, letters):
    out = list(text)
    for _ in range(rng.randint(0, most)):
        at, kind = rng.randint(0, len(out)), rng.randint(0, 2)
        if kind == 0:
            out.insert(at, rng.choice(letters))
        elif at < len(out):
            out[at : at + 1] = [] if kind == 1 else [rng.choice(letters)]
    return "".join(out)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_banded_edit_distance(distance):
    rng = random.Random(distance)
    left = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(800)]
    right = [changed(rng, x, distance + 2, "abc") for x in left]
    codes = [[np.frombuffer(x.encode("utf-32-le"), np.int32) for x in side] for side in (left, right)]
    assert line_dedup.within(*codes, distance).tolist() == [edits(a, b) <= distance for a, b in zip(left, right)]


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_copies_share_a_key_and_pass_the_sketch(distance):
    rng = random.Random(40 + distance)
    left = ["".join(rng.choice("abcdé 😀") for _ in range(rng.randint(distance + 1, 40))) for _ in range(600)]
    right = [changed(rng, x, distance, "abcdé 😀") for x in left]
    pairs = [(x, y) for x, y in zip(left, right) if min(len(x), len(y)) > distance and edits(x, y) <= distance]
    sketch, keys = line_dedup.sign([x for pair in pairs for x in pair], distance, 0)
    alone = [line_dedup.sign([x], distance, 0) for pair in pairs[:50] for x in pair]
    assert [int(s[0]) for s, _ in alone] == sketch[:100].tolist() and [k[0].tolist() for _, k in alone] == keys[:100].tolist()
    mask = 2**64 - 1
    for i in range(0, len(sketch), 2):
        own = [set(keys[j, : distance + 1].tolist()) - {0} for j in (i, i + 1)]
        every = [set(keys[j].tolist()) - {0} for j in (i, i + 1)]
        assert own[0] & every[1] or own[1] & every[0]
        apart = (int(sketch[i]) ^ int(sketch[i + 1])) & mask
        assert (apart >> 32).bit_count() <= 2 * distance and (apart & 0xFFFFFFFF).bit_count() <= 4 * distance


def test_line_dedup(spark):
    rng = random.Random(9)
    base = [prose(rng, 8) for _ in range(12)]
    rows = [(i, "\n".join(changed(rng, rng.choice(base), 3, "abc é") for _ in range(5)) + "\nshort\n \n", "s") for i in range(25)]
    rows += [(30, None, None), (31, "", None), (32, "short", None), (33, base[0] + "\n" + base[0], None), (None, base[1], None)]
    got = line_dedup.dedup_lines(docs_of(spark, rows)).collect()
    lines = [(i, k, x) for i, t, _ in rows for k, x in enumerate((t or "").split("\n")) if WORD.search(x)]
    lines.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))

    def same(a, b):
        return a == b or min(len(a), len(b)) >= 20 and edits(a, b) <= 2

    roots = components_of(len(lines), [(i, j) for i in range(len(lines)) for j in range(i) if same(lines[i][2], lines[j][2])])
    want = {(lines[i][0], lines[i][1], roots[i] == i) for i in range(len(lines))}
    assert {(r.doc_id, r.line_no, r.kept) for r in got} == want and len(got) == len(lines)
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


def test_line_dedup_query_lists_classes_verdicts_and_links(spark, tmp_path):
    rng = random.Random(19)
    base = [prose(rng, 8) for _ in range(5)]
    rows = [(i, "\n".join(changed(rng, rng.choice(base), 3, "abc é") for _ in range(4)) + "\nshort\n \n") for i in range(12)]
    rows += [(None, base[0] + "\nonly here, in a row without an id"), (None, base[1] + "\n\nshort"), (None, None), (20, ""), (21, None)]
    rows += [(3, base[2] + "\n" + base[2] + "\nagain"), (3, "short"), (7, base[4]), (7, base[4])]  # repeated ids, the last one with its text
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    from gleanwork.llm.queries import QUERIES
    prints = {(r.doc_id, r.text): r.p for r in docs.selectExpr("*", "xxhash64(text) p").collect()}

    lines = [(i, prints[i, t], k, x) for i, t in set(rows) for k, x in enumerate((t or "").split("\n")) if WORD.search(x)]
    lines.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2]))

    def same(a, b):
        return a == b or min(len(a), len(b)) >= 20 and edits(a, b) <= 2

    roots = components_of(len(lines), [(i, j) for i in range(len(lines)) for j in range(i) if same(lines[i][3], lines[j][3])])
    texts = {x[3] for x in lines}
    degree = {x: sum(x != y and same(x, y) for y in texts) for x in texts}
    listed = {}
    for i, (key, mark, k, x) in enumerate(lines):
        listed.setdefault((key, mark), []).append((k, *lines[roots[i]][:3], roots[i] == i, degree[x], len(x)))
    want = []
    for key, text in rows:
        own = sorted(listed.get((key, prints[key, text]), []))
        gone = [x for x in own if not x[4]]
        want.append((key, len(own), len(gone), sum(x[6] for x in gone), sum(x[5] for x in own), own))
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.dropped_chars, r.n_links, [tuple(x) for x in r.lines]) for r in QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(x[4] > 1 for x in want)


SCHEMA = {"f": {"properties": {"x": {"type": "integer"}}, "required": ["x"]}}
ITEMS = "conv bigint, turn bigint, kind string, role string, text string, call_id string, name string, arguments string, after array<string>, n bigint"


def test_chats(spark):
    def item(conv, turn, kind, role=None, text=None, call_id=None, name=None, arguments=None, after=None):
        return (conv, turn, kind, role, text, call_id, name, arguments, after, 1)

    rows = [
        item(1, 0, "message", "user", "hi é"), item(1, 1, "result", text="3", call_id="b"), item(1, 2, "call", call_id="b", name="f", arguments='{"x": 1}', after=["a"]),
        item(1, 3, "call", call_id="a", name="f", arguments='{"y":1}'), item(1, 4, "result", text="?", call_id="zz"),
        item(2, 0, "call", call_id="p", name="g", arguments="{", after=["q"]), item(2, 1, "call", call_id="q", name="f", arguments='{"x":true}', after=["p"]),
        item(3, 0, "message", None, None), item(3, 0, "message", None, None), item(None, 0, "message", "user", None),
        item(4, 0, "call", call_id="a", name="f", arguments='{"x":2}'), item(4, 1, "call", call_id="a", name="f", arguments='{"x":3}'), item(4, 2, "result", text="r", call_id="a"),
    ]
    got = {r.conv: r for r in chat.format_chats(spark.createDataFrame(rows, ITEMS), SCHEMA).collect()}
    first = json.loads(got[1].chat)["messages"]
    assert [m.get("tool_call", {}).get("id") or m.get("tool_call_id") for m in first] == [None, "a", "b", "b", "zz"]
    assert got[1].chat == json.dumps(json.loads(got[1].chat), sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    assert got[1].faults == {"bad_arguments": 1, "unanswered": 1, "orphan_result": 1}
    assert got[2].faults == {"circular": 2, "bad_arguments": 2, "unanswered": 2}
    assert got[3].faults == {"bad_role": 2} and got[None].faults == {}
    assert got[4].faults == {"repeated_call": 1}
    assert chat.format_chats(spark.createDataFrame([], ITEMS), SCHEMA).count() == 0


def test_classifier_accuracy_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = labels.where("doc_id % 3 = 0")
    got = quality_classifier.classify(docs, labels.where("doc_id % 3 <> 0"), F.col("source"), F.col("lang"))
    assert got.count() == docs.count()
    right = got.join(held, "doc_id").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.95


def test_classifier_shrinks_sparse_sites(spark, corpus):
    docs = docs_of(spark, corpus)
    labels = spark.createDataFrame([(1, None), (2, 1)], "doc_id bigint, quality int")
    got = quality_classifier.classify(docs, labels, F.col("source"), F.col("lang")).collect()
    assert len(got) == len(corpus) and all(r.evidence == 0 and r.posterior == pytest.approx(0.5) for r in got)
    assert quality_classifier.classify(docs_of(spark, []), labels, F.col("source"), F.col("lang")).count() == 0


def test_classifier_is_fitted_on_every_label(spark, monkeypatch):
    """A draw of 20,000 ids by hash, as there once was, has none of the good ones."""
    fitted_on, batch = [], "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(batch)

    class Counting(quality_classifier.LogisticRegression):
        def fit(self, dataset, params=None):
            fitted_on.append(dataset.count())
            assert spark.conf.get(batch) == "64"
            return super().fit(dataset, params)

    monkeypatch.setattr(quality_classifier, "LogisticRegression", Counting)
    ids = spark.range(21_000).withColumn("good", F.pmod(F.xxhash64("id"), F.lit(1_000_000)) >= 960_000)
    text = F.when(F.col("good"), F.concat(F.lit("a calm text about the sea, number "), F.col("id"))).otherwise(F.concat(F.lit("BUY BUY now!!! | $ | "), F.col("id")))
    docs = ids.select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("s").alias("source"), F.lit("en").alias("lang"))
    labels = ids.select(F.col("id").alias("doc_id"), F.col("good").cast("int").alias("quality"))
    evidence = quality_classifier.fit_evidence(docs, labels)
    assert evidence.model is not None and sum(fitted_on) == 21_000
    assert spark.conf.get(batch) == before
    rows = docs.join(labels, "doc_id").where("doc_id % 7 = 0").select(F.col("doc_id").alias("id"), "text", "quality")
    judged = quality_classifier.with_evidence(rows, evidence)
    assert judged.where((F.col("evidence") + evidence.base > 0) != (F.col("quality") == 1)).count() == 0


def test_labelled_texts_meet_ids_of_another_type(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, None)], "id bigint, text string")
    for kind in ("bigint", "int", "string"):
        known = spark.createDataFrame([(1, 1.0), (3, 0.0), (9, 1.0)], "id bigint, label double").withColumn("id", F.col("id").cast(kind))
        got = {(int(r.id), r.text, r.label) for r in quality_classifier._met(docs, known).collect()}
        assert got == {(1, "a", 1.0), (1, "b", 1.0), (3, None, 0.0)}


def test_shape_by_patterns(spark):
    rng = random.Random(4)
    signs = ["a", "a", "aa", "É", "|", "!", ".", "$", " ", " ", "  ", "\t", "\n", "\x0b", "\x1c", "\xa0", "a a", "no no"]
    texts = [None, "", " ", "a a a", "aa a", "a aa", *("".join(rng.choice(signs) for _ in range(rng.randint(1, 40))) for _ in range(200))]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for r in quality_classifier._prepared(rows).join(rows, "id").collect():
        body = r.text or ""
        tokens = re.findall(r"[^\x20\x09-\x0D]+", body)
        twins = re.findall(r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]+)(?=[\x20\x09-\x0D]+\1(?![^\x20\x09-\x0D]))", body)
        n = max(len(tokens), 1)
        assert (r.words, r.pairs) == (tokens, [f"{a} {b}" for a, b in zip(tokens, tokens[1:])])
        assert (r.twins, r.bars, r.shouts, r.stops) == (len(twins) / n, body.count("|") / n, body.count("!") / n, body.count(".") / n)
        assert r.symbols == body.count("$") / max(len(body), 1) and r.capitals == body.count("É") / max(len(body), 1)
        assert r.length == pytest.approx(math.log1p(len(tokens)) / 10)


def strength_of(groups):
    """`groups` are (n, rate, prior): the Beta prior's size by moments."""
    many = [(n, r, p, p * (1 - p)) for n, r, p in groups if n > 1 and p * (1 - p) > 0]
    room = sum((n - 1) * v for n, _, _, v in many)
    if not room:
        return quality_classifier.STRONGEST
    share = (sum(n * (r - p) ** 2 for n, r, p, _ in many) - sum(v for *_, v in many)) / room
    return min(max(1 / share - 1, quality_classifier.WEAKEST), quality_classifier.STRONGEST) if share > 0 else quality_classifier.STRONGEST


def test_sites_leave_the_document_out(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        host = rng.choice([None, "", "big", "big", f"h{rng.randint(0, 90)}"])
        lean = {"big": 2.0, None: -2.0}.get(host, 0.0)
        rows.append((i, host, rng.choice([None, "a", "b", f"p{i}"]), rng.gauss(lean, 1.5)))
    base = 0.4
    got = {r.id: r for r in quality_classifier.judge_sites(spark.createDataFrame(rows, "id bigint, host string, path string, evidence double"), base).collect()}
    good = {i: 1 / (1 + math.exp(-(e + base))) for i, _, _, e in rows}
    hosts, sections = {}, {}
    for i, h, p, _ in rows:
        hosts.setdefault(h, []).append(good[i])
        sections.setdefault((h, p), []).append(good[i])
    n, total = len(rows), sum(good.values())
    k = strength_of([(len(g), sum(g) / len(g), total / n) for g in hosts.values()])
    shrunk = {h: (sum(g) + k * total / n) / (len(g) + k) for h, g in hosts.items()}
    j = strength_of([(len(g), sum(g) / len(g), shrunk[h]) for (h, _), g in sections.items()])
    changed = 0
    for i, h, p, e in rows:
        host = (sum(hosts[h]) - good[i] + k * (total - good[i]) / (n - 1)) / (len(hosts[h]) - 1 + k)
        path = (sum(sections[h, p]) - good[i] + j * host) / (len(sections[h, p]) - 1 + j)
        posterior = 1 / (1 + math.exp(-(e + math.log(path / (1 - path)))))
        assert (got[i].host_rate, got[i].path_rate, got[i].posterior) == pytest.approx((host, path, posterior))
        assert got[i].kept == (got[i].posterior >= 0.5)
        changed += got[i].kept != (e + base >= 0)
    assert len(got) == n and min(map(len, sections.values())) == 1 and changed > n / 20


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cleaned = corpus_pipeline.quality_stage(spark, source, sf_dir).cache()
    kept = {r.doc_id for r in quality_rules.quality_rules(source).where("quality.kept").collect()}
    assert {r.doc_id for r in cleaned.collect()} == kept and cleaned.columns == source.columns
    unique = corpus_pipeline.exact_stage(spark, cleaned, sf_dir).cache()
    assert unique.count() == cleaned.select("text").distinct().count() and unique.columns == source.columns
    apart = corpus_pipeline.near_stage(spark, unique, sf_dir).cache()
    sets = {r.doc_id: shingle_set(r.text) for r in unique.collect()}
    ids = sorted(sets)
    links = [(i, j) for i in range(len(ids)) for j in range(i) if 100 * len(sets[ids[i]] & sets[ids[j]]) >= 75 * len(sets[ids[i]] | sets[ids[j]])]
    roots = components_of(len(ids), links)
    assert sorted(r.doc_id for r in apart.collect()) == [ids[i] for i in range(len(ids)) if roots[i] == i]
    mixed = corpus_pipeline.mixing_stage(spark, apart, sf_dir)
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(apart).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: c for i, c in copies.items() if c})
    assert mixed.columns == source.columns


def test_columns_grow_by_half_and_keep_their_values():
    column = pieces._Column(np.int32)
    for i in range(25):
        column.extend(np.arange(10_000) + i)
    assert column.size == 250_000 and len(column.data) <= 375_000
    assert column.data[: column.size].tolist() == [x + i for i in range(25) for x in range(10_000)]


def test_words_are_worked_out_once_while_the_memo_has_room(codec):
    words = [[f"{pieces.BLANK}w{i}x{j}" for j in range(1000)] for i in range(300)]
    for _ in range(2):
        met = [codec.lattices.words(words[i : i + 50]).numbers for i in range(0, 300, 50)]
    assert len(set(np.concatenate(met).tolist())) == 300_000
