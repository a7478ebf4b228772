"""Parts of the operators on small made-up inputs."""

from __future__ import annotations

import gzip
import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm import bpe, chat, decontamination, langid, quality, secrets, sharding, simhash, token_counts, warc
from shelfcast.llm.components import connected_components
from shelfcast.operators import joins


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("limit", [1, 100, 1000, 10**6])
def test_shards_keep_to_the_limit_and_are_minimal(spark, limit):
    rows = [(i % 50 if i % 3 else 7, 1 + i % 13) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, n long").withColumn("shard", F.lit("clash"))
    out = sharding.assign_shards(df, ["k"], F.col("n"), limit).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.n)
        assert r.local_depth == len(r.shard)
    assert all(sum(v) <= limit or len(v) == 1 for v in by.values())
    assert not any(a != b and b.startswith(a) for a in by for b in by)
    assert all(r.shard_bytes == sum(by[r.shard]) and r.shard_rows == len(by[r.shard]) for r in out)
    for shard in by:  # the bucket that was split into this one was too large
        assert not shard or sum(sum(v) for s, v in by.items() if s.startswith(shard[:-1])) > limit


def test_a_key_within_the_limit_stays_together(spark):
    df = spark.createDataFrame([(i % 20, 10) for i in range(400)], "k long, n long")
    out = sharding.assign_shards(df, ["k"], F.col("n"), 500).groupBy("k").agg(F.count_distinct("shard").alias("n"))
    assert {r.n for r in out.collect()} == {1}


@pytest.mark.parametrize("max_cell", [1, 4, 1000])
def test_fingerprint_links_join_what_brute_force_joins(spark, max_cell):
    rnd = random.Random(3)
    centres = [rnd.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    prints = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for c in centres for _ in range(25)}
    prints = sorted(prints)
    links = simhash.fingerprint_links(spark.createDataFrame([(_signed(p),) for p in prints], "fp long"), 2, max_cell)
    links = [(r.u, r.v) for r in links.collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in links)

    def groups(pairs):
        root = {_signed(p): _signed(p) for p in prints}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        out = {}
        for x in root:
            out.setdefault(find(x), set()).add(x)
        return sorted(map(sorted, out.values()))

    brute = [(_signed(a), _signed(b)) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 2]
    assert brute and groups(links) == groups(brute)


def test_embedding_is_the_manhattan_distance(spark):
    rnd = random.Random(5)
    values = [0, -1, *[_signed(rnd.getrandbits(64)) for _ in range(20)]]
    got = {r.x: r.e for r in spark.createDataFrame([(v,) for v in values], "x long").select("x", simhash.embedding(F.col("x")).alias("e")).collect()}

    def counts(x):
        return [((x >> i) & 3).bit_count() for i in range(0, 64, 2)]

    for a in values:
        for b in values:
            manhattan = sum(abs(p - q) for p, q in zip(counts(a & (2**64 - 1)), counts(b & (2**64 - 1))))
            assert ((got[a] ^ got[b]) & (2**64 - 1)).bit_count() == manhattan <= ((a ^ b) & (2**64 - 1)).bit_count()


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(10, 40)]
    links = spark.createDataFrame([*chain, *star, (70, 70), (71, 72), (72, 71), (72, 73)], "u long, v long")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, **{i: 5 for i in range(10, 40)}, 71: 71, 72: 71, 73: 71}
    assert connected_components(links.limit(0)).count() == 0


def test_forced_boundaries_inside_words():
    encoder = bpe.ForcedBoundaryEncoder(public_tokenizers.path("word_bpe_49k.json"))
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rnd = random.Random(1)
    letters = "abqxzjkvwéçñßøħʒžžæþ"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 40))) for _ in range(400)] + ["x" * 50_000, "áb ẛ̣ İ"]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids
    assert any(p.endswith(" ") for p in encoder.pieces)  # some words were cut inside


def test_encoder_of_a_vocabulary_with_spaces_in_tokens():
    encoder = bpe.ForcedBoundaryEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a  b\n\n c<|endoftext|> d", "it's  don't", " lead", "trail  ", "", "é　x  y"]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids
        assert bpe.Decoder(public_tokenizers.path("byte_bpe_50k.json")).decode(ids) == model.decode(
            np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False
        )


def test_memory_of_fragments_is_renewed(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 50)
    monkeypatch.setattr(bpe, "PART_BYTES", 200)
    encoder = bpe.ForcedBoundaryEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [f"word{i} word{i + 1} the of number {i}" for i in range(300)]
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) <= 60


def test_memory_is_bounded_by_characters_too(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_CHARS", 3000)
    monkeypatch.setattr(bpe, "PART_BYTES", 1000)
    monkeypatch.setattr(token_counts, "MEMORY_CHARS", 3000)
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 1000)
    texts = [f"{chr(0x4E00 + i) * 400} z{i} " + "ab" * i for i in range(100)]
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, model = bpe.ForcedBoundaryEncoder(path), Tokenizer.from_file(path)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids
    assert sum(map(len, encoder.known)) <= 4000 and sum(map(len, encoder.pieces)) <= 4000
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter, model = token_counts.Counter(path), Tokenizer.from_file(path)
    assert counter.count(texts) == [len(model.encode(t, add_special_tokens=False).ids) for t in texts]
    assert sum(map(len, counter.known)) <= 4000


def test_pieces_are_cut_at_safe_boundaries_only():
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counter = token_counts.Counter(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("aa  bb\n\n\tcc " * 30, "x" * 500, "a\x1cb\x85c d " * 20, "<|endoftext|>" * 20):
        for size in (1, 7, 50):
            parts = list(token_counts.pieces(text, size))
            assert "".join(parts) == text
            assert sum(counter.count(parts)) == len(model.encode(text, add_special_tokens=False).ids) == counter.count([text])[0]


def test_sentence_pieces_count_whole_texts():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", None, "hello  world é", "日本", "ab cd " * 200_000]
    assert token_counts.Counter(path).count(texts) == [len(model.encode(t or "")) for t in texts]


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_versions_are_parsed_by_declared_lengths(version):
    name = "x.arc"
    content = warc._arc_version_block(name, version)
    blocks = [b"", b"\n\nfiledesc://evil 0 0 0 9\n", b"HTTP/1.1 200 OK\r\n\r\nbody", "é".encode()]
    for b in blocks:
        content += warc._arc_record("http://a b/é", b, version, name, len(content))
    got = list(warc.parse_arc(content))
    assert [g[3] for g in got] == blocks and {g[0] for g in got} == {"http://a%20b/é"} and got[0][1:3] == (warc.CRAWL_DATE, "text/html")
    with pytest.raises(ValueError):
        list(warc.parse_arc(content[:-5]))


def test_small_payloads_are_never_revisits(spark):
    payloads = [b"xy", b"xy", b"longer", b"longer", b""]
    rows = [("a", i, str(i), "u", warc.CRAWL_DATE, warc.base32_sha1(p), len(p), b"", p) for i, p in enumerate(payloads)]
    records = spark.createDataFrame(rows, warc.RECORDS)
    out = warc.warc_records(records, warc.repeated_payloads(records, min_bytes=3)).collect()
    assert {r.key: (r.type, r.refers_to_key) for r in out} == {
        "0": ("response", None), "1": ("response", None), "2": ("response", None), "3": ("revisit", "2"), "4": ("response", None),
    }
    assert {r.stamp for r in out} == {"2020-01-01T00:00:00Z"}


def test_files_are_closed_by_bytes(spark, tmp_path):
    """Large pages among many small ones: only a page beyond the limit makes a file beyond it."""
    limit = 50_000
    rng = random.Random(5)
    pages = [(i, f"u{i}", "".join(rng.choices("abcdef <>", k=20_000 if i % 40 == 0 else 200))) for i in range(400)] + [(400, "big", "z" * 80_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)

    def written(path: str) -> list[bytes]:
        return [gzip.decompress(p.read_bytes()) for p in Path(path).glob("part-*")]

    warc.write_arc(df, str(tmp_path / "arc"), "page_id", "url", "html", limit=limit)
    slim = warc.read_arc(spark, str(tmp_path / "arc"), payloads=False)
    records = warc.warc_records(warc.read_arc(spark, str(tmp_path / "arc")), warc.repeated_payloads(slim))
    warc.write_warc(records.coalesce(1), str(tmp_path / "warc"), limit)
    for kind in ("arc", "warc"):
        sizes = sorted(len(c) for c in written(str(tmp_path / kind)))
        assert len(sizes) > 3 and sizes[-2] <= limit < sizes[-1] < 90_000
    back = warc.read_warc(spark, str(tmp_path / "warc")).collect()
    assert {(int(r.key), bytes(r.payload).decode()) for r in back} == {(i, html) for i, _, html in pages}


def test_escapes_are_reversible_and_leave_no_control():
    import pyarrow as pa

    texts = ["<|start|>", "<\\|start|>", "<\\\\|end|>", "a</s>[INST]<s>", "[/INST", "\\", "<|<|end|>", "[\\INST] [[INST]"]
    for text, escaped in zip(texts, chat.escape(pa.array(texts)).to_pylist()):
        assert chat.unescape(escaped) == text and not any(c in escaped for c in chat.CONTROLS)
    for role in ("user", "a\\nb", "x\n<|start|>", "\\l[", ""):
        written = chat.escape_role(pa.array([role]))[0].as_py()
        assert chat.unescape_role(written) == role and "\n" not in written and "<" not in written


def test_a_conversation_over_many_tasks(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"text {i} " * 5) for i in range(200)]
    parts = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 5)
    assert parts.count() == 5
    (row,) = chat.read_back(parts).collect()
    assert (row.n_turns, row.loss_chars) == (200, sum(len(t) for *_, r, t in rows if r == "assistant"))


def test_index_parts_and_length_classes_find_the_same(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 8, 20, 60, 70, 150, 300])]
    docs = [(i, " ".join(word() for _ in range(rnd.randint(0, 200))) + " " + t.upper() + ". " + " ".join(word() for _ in range(90))) for i, t in items]
    df = spark.createDataFrame([*docs, (99, "nothing here"), (100, None)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for words in (10**6, 100):
        got = decontamination.find_contamination(df, bench, index_words=words).collect()
        assert {(r.doc_id, m["item"]) for r in got for m in r.matches} >= {(i, i) for i, _ in items}
        assert {r.doc_id: len(r.matches) for r in got if r.doc_id >= 99} == {99: 0, 100: 0}


def test_a_bad_host_has_closer_limits(spark):
    good = " ".join(f"word{i}" for i in range(80))
    noisy = " ".join(f"w{i}###" for i in range(80))
    some = " ".join(f"word{i}" + ("#" if i % 2 else "") for i in range(80))  # 40 signs on some 500 characters
    more = " ".join(f"word{i}" + ("#" if i % 5 else "") for i in range(80))  # 64 on some 550
    rows = [(i, noisy, "bad.example") for i in range(9)] + [(9, good, "bad.example"), (10, some, "bad.example"), (11, some, "fine.example")]
    rows += [(12, more, "fine.example"), (13, more, None), (14, some, None), (15, noisy, "fine.example")]
    rows += [(i, good, "fine.example" if i < 60 else "other.example") for i in range(20, 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("kept", F.lit("clash"))
    out = {r.doc_id: r for r in quality.judge(df, carry=["doc_id", "kept"]).collect()}
    assert {i for i, r in out.items() if not r.kept} == {*range(9), 10, 13, 15}
    assert out[9].host_bad and out[9].kept and not out[11].host_bad and not out[13].host_bad


def test_rates_are_shrunk_by_the_prior_of_the_hosts(spark):
    """Against the formulas in plain numbers."""
    counts = {"a": (100, 10), "b": (50, 30), "c": (2, 2), "d": (400, 4)}
    rows = [(h, i < bad) for h, (n, bad) in counts.items() for i in range(n)] + [(None, True)] * 9
    df = spark.createDataFrame(rows, "host string, fails_base boolean")
    rates, means = quality.host_rates(df, "host", ["base"])
    raw = np.array([bad / n for n, bad in counts.values()])
    mean, strength = raw.mean(), max(raw.mean() * (1 - raw.mean()) / raw.var() - 1, 1.0)
    assert means["base"] == pytest.approx(mean)
    for r in rates.collect():
        n, bad = counts[r.host]
        assert r.rate_base == pytest.approx((bad + mean * strength) / (n + strength))


def test_a_column_called_found_is_not_carried(spark):
    df = spark.createDataFrame([(1, "token=abcdef1", "a", "x", "clash")], "doc_id long, text string, source string, lang string, found string")
    (row,) = secrets.find_secrets(df, carry=["doc_id", "found", "doc_id"]).collect()
    assert row.doc_id == 1 and [s["kind"] for s in row.found] == ["assign"]


def test_a_string_that_very_many_hold(spark, monkeypatch):
    """Split where it meets its owners, with the same result."""
    rows = [(i, "x token=shared99 y", f"s{i % 3}", "x") for i in range(60)] + [(60, "token=alone123", "s0", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4)
    monkeypatch.setattr(joins.hot_keys, "__kwdefaults__", {**joins.hot_keys.__kwdefaults__, "hot_rows": 5})
    monkeypatch.setattr(joins.attach, "__kwdefaults__", {**joins.attach.__kwdefaults__, "hot_rows": 5})
    out = {r.doc_id: [s["live"] for s in r.found] for r in secrets.find_secrets(df).collect()}
    assert out == {**{i: [False] for i in range(60)}, 60: [True]}
    near = simhash.near_duplicates(df, carry=["doc_id"]).collect()
    assert {r.doc_id: r.component_id for r in near} == {**dict.fromkeys(range(60), 0), 60: 60}
    assert {r.doc_id for r in simhash.near_duplicates(df, carry=["doc_id"], only_first=True).collect()} == {0, 60}


def test_a_language_of_copies_is_learnt(spark):
    rows = [(3 * i, f"der die das und nicht {i % 3}", "aa") for i in range(3000)]
    rows += [(3 * i, f"the of and with {i} that which", "bb") for i in range(3000, 3400)]
    network = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=50)
    assert network.languages == ["aa", "bb"]


def test_windows_of_many_texts_are_scored_as_alone():
    network = langid.Network.fresh(["x", "y", "z"])
    tables = network.tables()
    raw = [b"a", b"word " * 300, "é ü ß".encode() * 97, b"z" * langid.WINDOW, b"q" * (langid.WINDOW + 1)]
    together = langid.whole_texts(network, tables, raw)
    for text, (language, score) in zip(raw, together):
        data = np.frombuffer(text.lower(), dtype=np.uint8)
        logs, sizes = [], []
        for at in range(0, len(data), langid.WINDOW):
            window = np.zeros(langid.WINDOW + langid._REACH, dtype=np.uint8)
            part = data[at : at + len(window)]
            window[: len(part)] = part
            pooled = []
            for w, table in zip(langid.WIDTHS, network.filters):
                pooled.append(np.max([sum(table[j][window[p + j]] for j in range(w)) for p in range(langid.WINDOW)], axis=0))
            out = np.maximum(np.concatenate(pooled) + network.bias, 0) @ network.weights + network.offset
            e = np.exp(out - out.max())
            logs.append(np.log(e / e.sum() + 1e-9))
            sizes.append(min(langid.WINDOW, len(data) - at))
        mean = np.average(logs, axis=0, weights=sizes)
        p = np.exp(mean - mean.max()) / np.exp(mean - mean.max()).sum()
        assert network.languages[int(p.argmax())] == language and score == pytest.approx(p.max(), abs=1e-4)


def test_owned_strings_are_added_where_no_base_span_is(spark):
    rows = [(1, "key Abcdefghij0123456789K and copied0copied1copied2copied3", "a", "x"), (2, "copied0copied1copied2copied3", "b", "x")]
    out = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()
    assert {r.doc_id: [(s["kind"], s["start"], s["end"]) for s in r.found] for r in out} == {1: [("owned", 4, 25)], 2: []}
