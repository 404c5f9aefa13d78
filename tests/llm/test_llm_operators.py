"""The ten operators: odd rows, empty tables, and brute-force versions over the small tables."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestep.llm import (decontamination, language, licenses, mixing, near_dedup, passages, quality, queries, token_files,
                          url_filter, warc)
from lodestep.llm.components import components

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


def test_empty_tables(spark, none):
    items = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for frame in (mixing.mix_sizes(none), mixing.mix(none), warc.page_captures(pages), url_filter.judge_urls(pages),
                  decontamination.contamination(none, items), decontamination.decontaminate(none, items), language.languages(none),
                  language.keep_known(none), token_files.token_output(none, PATH), passages.repeated_passages(none),
                  licenses.license_scan(none), near_dedup.near_duplicates(none), near_dedup.drop_near_duplicates(none), quality.quality(none)):
        assert frame.count() == 0


def test_mix_odd_rows_and_budgets(odd):
    rows = mixing.mix_sizes(odd).collect()
    assert len(rows) == odd.count()
    taken, targets, sizes = defaultdict(int), {}, defaultdict(int)
    for row in rows:
        assert 0 <= row["taken"] <= 3 * row["size"]
        taken[row["source"]] += row["taken"]
        sizes[row["source"]] += row["size"]
        targets[row["source"]] = row["target"]
    assert all(int(targets[s]) == taken[s] for s in targets)
    assert abs(sum(targets.values()) - sum(sizes.values())) < 1e-6 and all(targets[s] <= 3 * sizes[s] for s in targets)
    assert mixing.mix(odd).columns == odd.columns


def test_mix_emits_whole_documents_near_budget(spark, data):
    docs = documents(spark, data)
    plan = mixing.mix_sizes(docs).groupBy("source").agg({"target": "max", "size": "max"}).collect()
    got = defaultdict(int)
    texts = {row["text"] for row in docs.collect()}
    for row in mixing.mix(docs).collect():
        assert row["text"] in texts
        got[row["source"]] += len(WORD.findall(row["text"]))
    for row in plan:
        assert abs(got[row["source"]] - row["max(target)"]) <= row["max(size)"]


def test_targets_reshare(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), (None, 500)], "source string, source_size long")
    found = {row["source"]: row["target"] for row in mixing.source_targets(sizes).collect()}
    assert found["a"] == 30.0 and found["c"] == 0.0
    assert found["b"] + found[None] == pytest.approx(1480) and found["b"] == pytest.approx(2 * found[None])


def test_warc(spark, tmp_path):
    big = "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n" * 5 + "é"
    rows = [(3, "http://a/\r\nb c", big), (1, None, big), (2, "u", big), (4, "u", "tiny"), (5, "u", "tiny"), (6, "u", None), (7, "u", "y" * 200_000)]
    pages = spark.createDataFrame([(*row, 1) for row in rows], "page_id long, url string, html string, payload int")
    got = {row["page_id"]: tuple(row)[1:] for row in warc.page_captures(pages).collect()}
    for page_id, _, html in rows:
        body = (html or "").encode()
        repeat = page_id in (2, 3)
        assert got[page_id] == (len(body), hashlib.sha256(body).hexdigest(), "revisit" if repeat else "response", 1 if repeat else None)
    folder = f"{tmp_path}/archive"
    warc.write_archives(pages, folder)
    nested = {row["metadata"]["fields"][0]["value"]: row for row in warc.transactions(warc.read_records(spark, folder)).collect()}
    assert len(nested) == 7 and bytes(nested["1"]["response"]["payload"]).decode() == big
    assert nested["3"]["request"]["http_head"].startswith("GET http://a/%20b%20c")


def test_warc_repeated_and_null_ids(spark, tmp_path):
    """Every row has a record and every payload is written, whatever the ids."""
    a, b, c = "a" * 150, "b" * 150, "c" * 150
    rows = [(1, a), (2, a), (2, b), (None, b), (None, c), (None, None), (5, c), (5, c), (6, c)]
    pages = spark.createDataFrame([(i, "u", t) for i, t in rows], "page_id long, url string, html string")
    got = sorted(((r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.page_captures(pages).collect()), key=str)
    first = {a: 1, b: 2, c: 5}
    want = sorted(((i, hashlib.sha256((t or "").encode()).hexdigest(), "response" if first.get(t, i) == i else "revisit",
                    None if first.get(t, i) == i else first[t]) for i, t in rows), key=str)
    assert got == want
    warc.write_archives(pages, f"{tmp_path}/archive")
    payloads = {bytes(r["payload"]).decode() for r in warc.read_records(spark, f"{tmp_path}/archive").where(
        "record_type = 'response'").select("payload").collect()}
    assert payloads == {a, b, c, ""}


def test_rows_of_one_id_are_dropped_by_their_texts(spark, docs_of):
    words = [f"w{i}" for i in range(400)]
    one, other = " ".join(words[:100]), " ".join(words[200:300])
    rows = [(1, one, "en", "s"), (5, one, "en", "s"), (5, other, "en", "s"), (7, other + " more", "en", "s"), (5, other, "en", "s")]
    kept = sorted((r["doc_id"], r["text"]) for r in near_dedup.drop_near_duplicates(docs_of(rows)).collect())
    assert kept == [(1, one), (5, other), (5, other)]


def test_all_stay_where_no_language_is_learned(docs_of):
    assert language.keep_known(docs_of([(i, "some text here", None, "s") for i in range(5)] + [(6, None, None, None)])).count() == 6


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://net/x", "https://a.NET", "https://A.net/?q", "http://x.example.net/en/1", "http://example.net/english",
            "http://notexample.com/de/1", "http://example.com/de/1?x", "s://u.org/fr/#a", "http://u.org/fr", "a://b://c/d", "http://xnet/"]
    found = {row["page_id"]: row for row in url_filter.judge_urls(spark.createDataFrame(
        [(i, url, 1) for i, url in enumerate(urls)], "page_id int, url string, rule int")).collect()}

    def expected(url):
        if not url or "://" not in url:
            return "", "", None
        rest = url.split("://", 1)[1]
        host = ascii_lower(re.split("[/?#]", rest)[0])
        path = re.split("[?#]", rest[len(host):])[0]
        fits = [(h + p) for _, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, max(fits, key=len) if fits else None
    for i, url in enumerate(urls):
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == expected(url), url
        assert found[i]["verdict"] in ("allow", "block")
    assert found[0]["verdict"] == found[1]["verdict"] == "allow"


@pytest.mark.parametrize("bucket_chars", [1 << 19, 200])
def test_url_scores_equal_plain_models(spark, bucket_chars):
    urls = [f"http://{('a', 'bé', 'shop')[i % 3]}{i % 7}.{('org/fr', 'net', 'com', 'example.com/de')[i % 4]}/{i * i % 101}" for i in range(120)]
    urls += [None, "", "no scheme", "x" * 3_000, *["http://hot.com/"] * 60]
    rows = spark.createDataFrame([(None if i == 5 else 2**60 + i % 150, url, 1) for i, url in enumerate(urls)], "page_id long, url string, score int")
    found = url_filter.judge_urls(rows, bucket_chars=bucket_chars).collect()
    assert len(found) == len(urls)
    ruled = {}
    for url in urls:
        host, path = ("", "") if "://" not in (url or "") else (url.split("/")[2], "/" + url.split("/", 3)[3])
        fits = [(len(h + p), v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        ruled[url] = max(fits)[1] if fits else None
    held = spark.createDataFrame([(url,) for url in set(urls) if url], "url string").where(
        F.pmod(F.xxhash64("url"), F.lit(url_filter.HOLD_OUT)) == 0).collect()
    held = {row["url"] for row in held}
    seen = {name: defaultdict(int) for name in url_filter.CLASSES}
    for url in urls:
        if ruled[url] and url not in held:
            data = bytes(4) + url.encode()
            for at in range(4, len(data)):
                for order in range(5):
                    seen[ruled[url]][data[at - order:at], None] += 1
                    seen[ruled[url]][data[at - order:at], data[at]] += 1

    def score(url):
        data, logs = bytes(4) + (url or "").encode(), 0.0
        for at in range(4, len(data)):
            for sign, counts in zip((1, -1), seen.values()):
                estimate = 1 / 256
                for order in range(5):
                    context = data[at - order:at]
                    estimate = (counts[context, data[at]] + 2 * estimate) / (counts[context, None] + 2)
                logs += sign * np.log(estimate)
        return logs / max(len(data) - 4, 1)

    got = sorted((row["page_id"] or 0, row["host"], row["path"], row["verdict"] if ruled_by else "", row["score"] if not ruled_by else None)
                 for row in found for ruled_by in [row["rule"]] if not ruled_by)
    want = sorted((0 if i == 5 else 2**60 + i % 150, score(url)) for i, url in enumerate(urls) if not ruled[url])
    assert len(got) == len(want)
    assert np.allclose(sorted(row[-1] for row in got), sorted(x for _, x in want)) and [row[0] for row in got] == [x for x, _ in want]


def test_url_models_tell_hosts_apart(spark):
    good = [f"http://site{i % 40}.example.net/en/story-{i}" for i in range(400)]
    bad = [f"http://cheap-pills-{i % 40}.net/buy-now-{i}" for i in range(400)]
    new = [f"http://site{i}.example.com/en/story-{i}" for i in range(40)] + [f"http://cheap-pills-{i}.com/buy-now-{i}" for i in range(40)]
    rows = spark.createDataFrame(list(enumerate(good + bad + new)), "page_id long, url string")
    got = {row["page_id"]: row["verdict"] for row in url_filter.judge_urls(rows).collect()}
    assert sum(got[800 + i] == ("allow" if i < 40 else "block") for i in range(80)) >= 76


def test_decontamination_odd_rows(spark, docs_of):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    items = spark.createDataFrame([(1, item), (2, "Short Näme"), (3, None), (4, "..."), (10, item + " nu")], "item_id long, text string")
    rows = [(1, f"x {item.upper()}, y", None, None), (2, None, None, None), (3, "short näme short näme", None, None), (3, "short NÄME", None, None),
            (None, "a " * 50 + item, None, None), (5, " ".join(item.split()[:9]), None, None), (5, " ".join(item.split()[:9]), None, None)]
    got = sorted(((row["doc_id"] or 0, row["n_words"], row["n_hit"], row["n_items"], row["items_sha256"]) for row in
                  decontamination.contamination(docs_of(rows, clash=("n_hit", "start", "term")), items).collect()))

    def sha(ids):
        return hashlib.sha256(ids.encode()).hexdigest()
    assert got == sorted([(1, 14, 12, 2, sha("1,10")), (2, 0, 0, 0, sha("")), (3, 4, 4, 1, sha("2")), (3, 2, 0, 0, sha("")), (0, 62, 12, 2, sha("1,10")),
                          (5, 9, 0, 0, sha("")), (5, 9, 0, 0, sha(""))])


def test_proximity(spark, docs_of):
    items = spark.createDataFrame([(1, "alpha omega common common common common common common common common")], "item_id long, text string")
    docs = docs_of([(1, "omega x x alpha", None, None), (2, "omega " + "x " * 40 + "alpha", None, None), (3, "common " * 20, None, None)])
    found = decontamination.proximity_matches(docs, items).collect()
    assert {row["doc_id"] for row in found} == {1} and found[0]["first_at"] == 1 and found[0]["last_at"] == 4


def test_language(spark, data, odd):
    rows = language.languages(documents(spark, data)).join(documents(spark, data), "doc_id").collect()
    out = [row for row in rows if row["held_out"]]
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1) and 0 <= row["score"] <= 1 for row in rows)
    assert sum(row["lang"] == row["lang_pred"] for row in out) > 0.97 * len(out)
    got = language.languages(odd).collect()
    assert len(got) == odd.count() and sum(row["lang_pred"] == "und" for row in got) == 3


def test_cross_parsing_is_greedy_longest_match():
    random = np.random.default_rng(3)
    model, text = ("".join(random.choice(list("ab c"), n)) for n in (300, 200))
    classes, starts, ends = language.coded([text])
    known = "".join(map(chr, language.coded([model])[0]))
    seen, count, at = "".join(map(chr, classes)), 0, 0
    while at < len(seen):
        size = 1
        while at + size < len(seen) and seen[at:at + size + 1] in known:
            size += 1
        at, count = at + size, count + 1
    assert language.phrases(language.automaton(language.coded([model])[0]), classes, starts, ends).tolist() == [count]


def test_token_files(spark, data, odd, tmp_path):
    tokenizer = Tokenizer.from_file(PATH)
    for docs in (documents(spark, data), odd):
        folder = f"{tmp_path}/{docs.count()}"
        token_files.write_token_files(docs, folder, PATH, file_bytes=20_000)
        got = [tuple(row) for row in token_files.token_index(spark, folder).collect()]
        coded = sorted(((row["doc_id"], np.array(tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [0], "<u4").tobytes())
                        for row in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
        assert sorted((x[0] or -1, x[2], x[3]) for x in got) == sorted((i or -1, len(b) // 4, zlib.crc32(b)) for i, b in coded)
        start = 0
        for row in sorted(got, key=lambda x: x[1]):
            assert row[1] == start
            start += row[2]
        assert [x[0] for x in sorted(got, key=lambda x: x[1])] == [i for i, _ in coded]
        texts = {row["doc_id"]: tokenizer.decode(np.frombuffer(row["ids"], "<u4")[:-1].tolist()) for row in
                 token_files.read_token_files(spark, folder).collect()}
        assert texts[3] == next(row["text"] for row in docs.collect() if row["doc_id"] == 3)


def test_pack_round_trip():
    random = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        values = (random.integers(0, 2**32, n, np.uint64) >> random.integers(0, 32, n, np.uint64)).astype(np.uint32)
        assert (token_files.unpack(token_files.pack(values), n) == values).all()


def test_pack_of_many_documents_equals_one_by_one():
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 1 << rng.integers(1, 33), n, dtype=np.uint64).astype(np.uint32) for n in (0, 1, 4, 5, 0, 777, 3, 2)]
    packed = token_files.pack_all(np.concatenate(parts), np.array([len(p) for p in parts]))
    assert packed == [token_files.pack(p) for p in parts]
    assert all((token_files.unpack(code, len(p)) == p).all() for code, p in zip(packed, parts))


def test_words_and_whole_texts_encode_alike():
    words, tokenizer = token_files.WordIds(PATH), Tokenizer.from_file(PATH)
    for text in ("a  b", "a \nb", " x", "x ", "it's 'tis ''s", "a\u00a0 b", "\n\n b", "   ", "é1st, 3.5%", "K\u212a. 漢字 😀!", "a,b c.."):
        assert np.frombuffer(words.ids(text), words.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_added_tokens_in_texts(spark, docs_of):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", "a <|endoftext| > b", "plain words", None]
    encode = Tokenizer.from_file(PATH).encode
    got = sorted(token_files.token_output(docs_of([(i, text, None, None) for i, text in enumerate(texts)]), PATH).collect())
    start = 0
    for row, text in zip(got, texts):
        ids = encode(text or "", add_special_tokens=False).ids + [token_files.END]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text
        start += len(ids)
    assert 50256 in encode(texts[0], add_special_tokens=False).ids


def test_passages(spark, data, docs_of):
    docs = documents(spark, data).collect()
    shared = defaultdict(set)
    for row in docs:
        words = (row["text"] or "").encode().lower().split()
        for i in range(len(words) - 49):
            window = tuple(words[i:i + 50])
            if len(set(window)) > 25:
                shared[window].add(row["doc_id"])
    wanted = set().union(*(ids for ids in shared.values() if len(ids) > 1))
    got = passages.repeated_passages(documents(spark, data)).collect()
    assert wanted <= {row["doc_id"] for row in got} and len({row["doc_id"] for row in got if not row["removed"]}) > 0
    plain = [" ".join(f"{name}{i}" for i in range(90)) for name in "abcd"]
    passage = " ".join(f"p{i}" for i in range(51))
    made = docs_of([(1, f"{plain[0]} {passage} {plain[1]}", None, None), (2, f"{plain[2]} {passage}", None, None), (3, plain[3], None, None),
                    (4, None, None, None), (None, passage, None, None), (5, "le " * 200, None, None), (6, "le " * 200, None, None)], clash=("at", "digest"))
    rows = passages.repeated_passages(made).collect()
    assert {row["doc_id"] for row in rows} == {1, 2} and {row["doc_id"] for row in rows if row["removed"]} == {2}
    assert all(row["original_id"] == 1 for row in rows)


def test_passages_are_whole(spark, docs_of):
    """Every word of 50 and more in a row that an earlier document has too is in a span; words beside a paragraph stand so in an earlier one."""
    rng, fresh = np.random.default_rng(3), iter(range(1_000_000))
    passages_of = [[f"P{number}x{i}" for i in range(50 + 13 * number)] for number in range(6)]
    texts = {}
    for doc_id in range(30):
        words = []
        for number in rng.integers(0, 6, 3):
            cut = rng.integers(0, 8) if rng.random() < 0.3 else 0
            words += [f"n{next(fresh)}" for _ in range(rng.integers(0, 45))] + passages_of[number][cut:]
        texts[doc_id] = words
    docs = docs_of([(doc_id, " ".join(words), None, None) for doc_id, words in texts.items()] + [(31, "and so on " * 40, None, None)])
    covered, grown = defaultdict(set), 0
    for row in passages.repeated_passages(docs.repartition(3)).collect():
        doc_id, first, n = row["doc_id"], row["first_word"], row["n_words"]
        if row["doc_id"] != row["original_id"]:
            span = texts[doc_id][first:first + n]
            assert len(span) == n >= 20
            covered[doc_id] |= set(range(first, first + n))
            earlier = " | ".join(" ".join(texts[other]) for other in range(doc_id))
            stands = {i + k for i in range(n - 19) if f" {' '.join(span[i:i + 20])} " in f" {earlier} " for k in range(20)}
            assert n == 20 or stands == set(range(n))
            grown += n > 20
    windows = {}
    for doc_id, words in texts.items():
        own = [tuple(words[i:i + 50]) for i in range(len(words) - 49)]
        wanted = {i + k for i, window in enumerate(own) if windows.get(window, doc_id) < doc_id for k in range(50)}
        assert wanted <= covered[doc_id], doc_id
        for window in own:
            windows.setdefault(window, doc_id)
    assert grown


def test_spans_of_repeated_rows_come_once(spark, docs_of):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"a b c {passage} d", None, None), (2, f"x y {passage} z", None, None)]
    once, twice = (sorted(map(tuple, passages.repeated_passages(docs_of(some)).collect())) for some in (rows, rows + rows))
    assert once == twice and any(row[0] == 2 and row[2] > 20 for row in once)


def test_passages_beside_repeats(spark, docs_of):
    """A start whose paragraph repeats itself gives way to one beside it."""
    texts = []
    for number in range(40):
        texts.append(" ".join([f"u{number}x{i}" for i in range(30)] + ["la", "li"] * 30))
    found = {row["doc_id"] for row in passages.paragraphs(docs_of([(i, text, None, None) for i, text in enumerate(texts)])).collect()}
    assert found == set(range(40))


def test_passages_chains(spark, docs_of):
    """Edited copies of one passage whose ends differ, all in one group: most are linked to others by way of a few only."""
    core = " ".join(f"c{i}" for i in range(16))
    rows = [(36 * chain + 3 * i + j, f"p{chain}x{i} p{chain}y{i} {core} q{chain}x{i + j} q{chain}y{i + j}", None, None)
            for chain in range(2) for i in range(12) for j in range(3)]
    docs = docs_of(rows)
    found = passages.paragraphs(docs).withColumn("bands", F.array(F.lit(7).cast("long"))).cache()
    classes = found.groupBy("digest").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.max("doc_id").alias("last_id"))
    linked = components(passages.paragraph_links(docs, found, classes)).join(found, F.col("id") == F.col("digest")).collect()
    groups = defaultdict(set)
    for row in linked:
        groups[row["component"]].add(row["doc_id"])
    shingles = {i: {tuple(text.split()[k:k + 5]) for k in range(16)} for i, text, *_ in rows}
    want, left = set(), set(shingles)
    while left:
        group, todo = set(), [min(left)]
        while todo:
            one = todo.pop()
            group.add(one)
            todo += [i for i in left - group if 100 * len(shingles[i] & shingles[one]) >= 75 * len(shingles[i] | shingles[one])]
        left -= group
        want.add(frozenset(group))
    assert len(want) == 2 and set(map(frozenset, groups.values())) == want


def test_licenses(spark, data, odd, docs_of):
    phrases = [(label, text.lower().replace(",", "").replace("-", " ").split()) for label, text in licenses.PHRASES]
    for docs in (documents(spark, data), odd, docs_of([
            (1, "Under the MIT\nLicense. under THE mit-license", None, None), (2, "CC BY-NC cc by nc", None, None), (3, "the mit license", None, None),
            (4, licenses.NOTICES[1][1].replace("[", "").replace("]", ""), None, None), (5, "K\u212a under the MIT license", None, None),
            (6, "GNU General Public License, version 3. This work is licensed under the", None, None)])):
        got = defaultdict(list)
        for row in licenses.license_scan(docs).collect():
            got[row["doc_id"]].append((row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]))
            assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(",")) and (row["score"] > 0) == bool(row["labels"])
        want = defaultdict(list)
        for row in docs.collect():
            words = TERM.findall(ascii_lower(row["text"]))
            places = sorted((i, label) for label, phrase in phrases for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
            want[row["doc_id"]].append((len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                                        ",".join(sorted({label for _, label in places}))))
        assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}


PRINTED = {
    "mit": """Copyright (c) 2020 A. Uthor

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is""",
    "apache-2": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at""",
    "bsd-3": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.""",
    "gpl-3": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "isc": """Permission to use, copy, modify, and distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
}


def test_licenses_as_printed(spark, docs_of):
    wordy = PRINTED["mit"].replace("to deal", "and all of its parts, to deal")
    split = PRINTED["mit"].replace("without restriction", "without any restriction")
    far = PRINTED["mit"].replace("to deal", "x " * 40 + "to deal")
    texts = [*PRINTED.values(), wordy, split, far]
    rows = [(i, text, None, None) for i, text in enumerate(texts)] + [(None, PRINTED["mit"], None, None)]
    got = {row["doc_id"]: (row["labels"], row["score"]) for row in licenses.license_scan(docs_of(rows)).collect()}
    for i, label in enumerate(PRINTED):
        assert label in got[i][0].split(",") and got[i][1] == 1, label
    n = len(PRINTED)
    assert got[n] == ("mit", 1) and got[n + 1] == got[n + 2] == ("", 0) and got[None] == ("mit", 1)


def brute_components(rows):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        sets[doc_id] = frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 4 >= max(len(x), len(y)) * 3 and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates(spark, data, docs_of):
    docs = documents(spark, data)
    got = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in near_dedup.near_duplicates(docs).collect()}
    assert got == brute_components([(row["doc_id"], row["text"]) for row in docs.collect()])
    random = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base), None, None), (900, None, None, None), (901, "", None, None), (902, "A b", None, None), (903, "a B", None, None)]
    for i in range(1, 60):
        words = list(base)
        for at in random.choice(120, random.integers(1, 6), replace=False):
            words[at] = f"v{i}x{at}"
        rows.append((i, " ".join(words), None, None))
    made = docs_of(rows, clash=("n", "member", "digest"))
    got = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in near_dedup.near_duplicates(made).collect()}
    assert got == brute_components([(row[0], row[1]) for row in rows])
    kept = near_dedup.drop_near_duplicates(made)
    assert kept.columns == made.columns and {row["doc_id"] for row in kept.collect()} == {i for i, (_, c) in got.items() if i == c}


def test_near_duplicates_refuse_what_trees_cannot_find(none):
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(none, percent=50)


def test_near_duplicates_chains(spark, docs_of):
    """Copies of copies drift from the first text, so most members of the large nodes are linked to few others."""
    random = np.random.default_rng(1)
    rows = []
    for size, drift in ((150, True), (60, False)):
        base = [f"w{i}" for i in random.integers(0, 5000, 150)]
        words = base
        for _ in range(size):
            words = [f"v{random.integers(10**9)}" if random.random() < .02 else word for word in (words if drift else base)]
            rows.append((len(rows), " ".join(words), None, None))
    rows = [(int(i), *rows[j][1:]) for i, j in enumerate(random.permutation(len(rows)))]
    got = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in near_dedup.near_duplicates(docs_of(rows)).collect()}
    assert got == brute_components([(row[0], row[1]) for row in rows])


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {row["id"]: row["component"] for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)}


def test_quality_counts(spark, data, odd):
    for docs in (documents(spark, data), odd):
        got, want = defaultdict(list), defaultdict(list)
        for row in quality.quality(docs).collect():
            got[row["doc_id"]].append((row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"], row["base_failed"]))
            assert not (row["kept"] and row["base_failed"])
        for row in docs.collect():
            text = row["text"] or ""
            words, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
            windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
            count = defaultdict(int)
            for window in windows:
                count[window] += 1
            repeated = {i + j for i, window in enumerate(windows) if count[window] > 1 for j in range(5)}
            failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
            want[row["doc_id"]].append((len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                                        len(repeated), failed))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_quality_drops_junk_and_keeps_prose(spark, docs_of):
    prose = "The house of the king is in the old town and it was for a long time on the hill to the west of that river. " * 1
    texts = [f"{prose} Number word{i} and the other word{i + 1} in a row of it{i}." + prose.replace("king", f"lord{i}") for i in range(30)]
    junk = " ".join(f"w{i}%%% x{i}### $$$" for i in range(60))
    rows = [(i, text, "en", None) for i, text in enumerate(texts)] + [(99, junk, "en", None)]
    got = {row["doc_id"]: row["kept"] for row in quality.quality(docs_of(rows), max_repeat_percent=100).collect()}
    assert not got.pop(99) and all(got.values())


def prose(n):
    """Unlike clean texts of some 70 words."""
    line = "The house of the king is in the old town and it was for a long time on the hill to the west of that river."
    return [f"{line} Number word{i} and the other word{i + 1} in a row of it{i}. {line.replace('king', f'lord{i}')}" for i in range(n)]


@pytest.mark.parametrize("junk", [
    [" ".join(f"w{j}%%% x{j}### $$$" for j in range(2_000 + i)) for i in range(5)],
    [" ".join(f"w{j}%%% x{j}### $$$" for j in range(60))] * 30,
    [" ".join(f"W{j}{i} QRST 2024 #" for j in range(60)) for i in range(30)],
    ["the of " * 2_000, "### " * 2_000, "1 2 3"]], ids=["a few long", "a third of copies", "a third unlike", "failed by the base rules"])
def test_junk_does_not_become_the_reference(docs_of, junk):
    texts = prose(60)
    rows = [(i, text, "en", None) for i, text in enumerate(texts)] + [(1000 + i, text, "en", None) for i, text in enumerate(junk)]
    found = quality.quality(docs_of(rows), max_repeat_percent=90).collect()
    assert {row["doc_id"] for row in found if row["kept"]} == set(range(60))


def test_quality_references(spark, docs_of):
    rows = [(i, text, ("en", "xx")[i % 2], None) for i, text in enumerate(prose(40))]
    found = {row["doc_id"]: row for row in quality.quality(docs_of(rows + rows[:2] * 50), max_repeat_percent=100).collect()}

    def shares(text):
        words = "".join(WORD.findall(text))
        upper, digits, symbols = (len(re.findall(pattern, words)) for pattern in ("[A-Z]", "[0-9]", r"[#*$%&|<>]"))
        marks = len(re.findall(r"[.,;:!?'\"()\-]", words))
        return np.array([upper, digits, symbols, marks, len(text) - len(words), len(words) - upper - digits - symbols - marks]) / len(text)

    for group in (0, 1):
        mine = np.array([shares(text) for _, text, _, _ in rows[group::2]])
        middle = np.percentile(mine.round(3), [35, 40, 45, 50, 55, 60, 65], axis=0).mean(0)
        for (i, *_), p in zip(rows[group::2], mine):
            q = middle / middle.sum()
            m = (p + q) / 2
            want = sum(x * np.log2(x / y) for x, y in zip([*p, *q], [*m, *m]) if x > 0) / 2
            assert abs(found[i]["char_distance"] - max(want, 0) ** 0.5) < 1e-9 and (found[i]["word_distance"] is None) == (group == 1)
    few = quality.quality(docs_of([(1, " ".join(f"w{i}%%% $$$" for i in range(60)), "en", None)])).collect()[0]
    assert few["kept"] and few["char_distance"] is None


def test_queries_cover_the_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
