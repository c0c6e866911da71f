"""The corpus operators against brute force on small fixtures with odd rows."""

import hashlib
import re
import struct
from collections import defaultdict

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from airledger.llm import op1_toxicity as tox
from airledger.llm import op2_url_filters as urls
from airledger.llm import op5_secrets as sec
from airledger.llm import op7_bpe as bpe
from airledger.llm import op8_quality as quality
from airledger.llm import op9_quality_rules as rules
from airledger.llm.op3_minhash_dedup import near_duplicates, without_near_duplicates
from airledger.llm.op4_suffix_dedup import difference_cover, repeated_bytes
from airledger.llm.op6_substring_dedup import repeated_words
from airledger.llm.op10_decontamination import contamination, decontaminated

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def prose(seed, count):
    names = "orin tael mosk vire pond quil ashe brem corda dune elk fyn gorse halm isk jute".split()
    out, x = [], seed
    for _ in range(count):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(names[x >> 60] + names[(x >> 50) % 16] * ((x >> 40) % 2))
    return " ".join(out)


def texts():
    base = prose(1, 300)
    near = base.split()
    near[100:104] = ["changed"] * 4
    return [
        base,
        base,
        " ".join(near),
        prose(2, 40) + "\n" + " ".join(base.split()[50:150]) + "\té",
        None,
        "",
        " \t\n",
        "one two three",
        "One two THREE",
        "same " * 700,
        "x" * 30_000,
        "x" * 1000 + "y",
        prose(9, 2500),
        "Ünï " + prose(2, 60),
        prose(2, 60).upper(),
    ]


@pytest.fixture(scope="module")
def rows():
    found = [Row(i, t, "en", "s", len(t or ""), "z") for i, t in enumerate(texts())]
    return [*found, found[0], Row(None, "lost words here", None, None, None, None), found[4]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def bag(found):
    return sorted(found, key=repr)


def test_difference_cover_covers():
    v, members = difference_cover(5)
    assert len({(a - b) % v for a in members for b in members}) == v == 31


@pytest.mark.parametrize("length,block_bytes", [(400, 8 << 20), (40, 20_000), (1, 5_000)])
def test_repeated_bytes(docs, rows, length, block_bytes):
    seen = defaultdict(int)
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, text in data:
        for at in range(len(text) - length + 1):
            seen[text[at : at + length]] += 1
    expected = []
    for doc_id, text in data:
        mask = bytearray(len(text))
        for at in range(len(text) - length + 1):
            if seen[text[at : at + length]] > 1:
                mask[at : at + length] = b"\1" * length
        kept = bytes(x for x, gone in zip(text, mask) if not gone)
        spans = len(re.findall(b"\1+", bytes(mask)))
        expected.append((doc_id, len(text), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    found = [tuple(r)[:5] for r in repeated_bytes(docs, length, block_bytes).collect()]
    assert bag(found) == bag(expected)


@pytest.mark.parametrize("window,block_bytes", [(20, 8 << 20), (20, 3_000), (3, 3_000)])
def test_repeated_words(docs, rows, window, block_bytes):
    seen, expected = set(), []
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        own = words(r[1])
        gone = [False] * len(own)
        for at in range(len(own) - window + 1):
            key = tuple(own[at : at + window])
            if key in seen:
                gone[at : at + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        expected.append((r[0], len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = [tuple(r)[:4] for r in repeated_words(docs, window, block_bytes=block_bytes).collect()]
    assert bag(found) == bag(expected)


def components_of(rows):
    sets = []
    for r in rows:
        own = words((r[1] or "").translate(LOWER))
        many = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        sets.append(many or ({tuple(own)} if own else set()))
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g] = min(r[0], least.get(g, r[0]))
    return [(r[0], len(s), least.get(g), r[0] == least.get(g)) for r, s, g in zip(rows, sets, group)]


def test_near_duplicates(spark, docs, rows):
    # A chain whose ends are too far apart, among lines that all of them share.
    line = prose(77, 14)
    chain = prose(5, 120).split()
    more = [Row(100, " ".join(chain), "en", "s", 1, "")]
    for i in range(1, 6):
        chain[i * 15] = f"edit{i}"
        more.append(Row(100 + i, " ".join(chain), "en", "s", 1, ""))
    more += [Row(200 + i, f"{line} {prose(300 + i, 12 + i)}", "en", "s", 1, "") for i in range(60)]
    everything = [*rows, *more]
    frame = spark.createDataFrame(everything, SCHEMA)
    found = [tuple(r)[:4] for r in near_duplicates(frame, block_bytes=4_000).collect()]
    assert bag(found) == bag(components_of(everything))
    kept = without_near_duplicates(frame)
    assert kept.columns == frame.columns
    groups = {(c if c is not None else "lost") for _, n, c, _ in components_of(everything) if n}
    assert kept.where("text rlike '[a-z]'").count() == len(groups)


def test_contamination(spark, docs, rows):
    items = [
        (1, " ".join(words(texts()[0])[20:45]) + "!"),
        (2, "two, THREE"),
        (3, None),
        (4, " - "),
        (1, "one"),
        (None, "lost words"),
        (11, " ".join(words(texts()[0])[30:41])),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = defaultdict(set)
    for item, text in items:
        own = split((text or "").translate(LOWER))
        for at in range(max(1, len(own) - 9) if own else 0):
            windows[tuple(own[at : at + 10])].add(item)
    expected = []
    for r in rows:
        own = split((r[1] or "").translate(LOWER))
        hit, found = [0] * len(own), set()
        for window, of in windows.items():
            for at in range(len(own) - len(window) + 1):
                if tuple(own[at : at + len(window)]) == window:
                    hit[at : at + len(window)] = [1] * len(window)
                    found |= of
        expected.append((r[0], len(own), sum(hit), sorted(found - {None})))
    for most in (1000, 4):
        found = [
            (r.doc_id, r._n_words, sum(s.end - s.start for s in r._word_spans), sorted(r._items))
            for r in contamination(docs, bench, most=most).collect()
        ]
        assert bag(found) == bag(expected)
    cleaned = decontaminated(docs, bench)
    assert cleaned.dtypes == docs.dtypes
    again = contamination(cleaned, bench.where("item_id = 11")).where("size(_items) > 0")
    assert again.isEmpty()
    assert contamination(docs, bench.limit(0)).where("size(_items) > 0").isEmpty()


def test_bpe_equals_the_library(docs, rows):
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.public_tokenizers.path(bpe.TOKENIZER)
    library = tokenizers.Tokenizer.from_file(path)
    mine = bpe.Bpe(open(path, encoding="utf-8").read())
    odd = ["<|endoftext|> it'S don't", "ΟΔΟΣ ΣΑΣ", "a" * 50, "é\x85\x1c!!!", "İx 12 ½", "hahaha" * 9]
    for text in [*odd, *[r[1] or "" for r in rows]]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert mine.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
        assert mine.decode(mine.encode(text)) == library.decode(ids, skip_special_tokens=False)
    found = bpe.round_trip(docs)
    assert found.where("length(text) > 0 and octet_length(ids) = 0 and text rlike '[a-z]'").isEmpty()
    assert found.count() == len(rows)


def test_secrets():
    text = 'salt = "Zx81kkQ0pP22"\npassword = salt\nplain = "Zx81kkQ0pP23"\ntoken: abcdef'
    spans = sec.spans_of(text)
    assert ("literal", text.index("Zx81kkQ0pP22")) in {(k, s) for s, k, _ in spans}
    assert text.index("Zx81kkQ0pP23") not in {s for s, _, _ in spans}
    assert (text.index("token"), "assign", len(text)) in spans
    assert not [k for _, k, _ in sec.spans_of("secret: token: abcdefgh") if k == "assign"]
    assert [k for _, k, _ in sec.spans_of("AKIA" + "A" * 15)] == []
    assert [k for _, k, _ in sec.spans_of("AKIA" + "A" * 16 + " " + "a1" * 12)] == ["access", "hex"]
    assert "Zx81kkQ0pP22" not in sec.redact(text, spans)


def test_redacted_keeps_clean_rows(docs):
    assert bag(map(tuple, sec.redacted(docs).collect())) == bag(map(tuple, docs.collect()))


def test_toxicity(spark):
    made = [(i, prose(i, 60) + (" vile" if i % 5 == 0 else ""), i) for i in range(200)]
    frame = spark.createDataFrame([*made, (None, None, 0)], "doc_id bigint, text string, grade int")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(100)], "doc_id bigint, toxic int")
    model = tox.fit(frame, labels)
    found = {r.doc_id: r.toxic for r in tox.graded(frame, model).collect()}
    assert {i for i, bad in found.items() if bad} == {*range(0, 200, 5)}
    left = tox.without_toxic(frame, labels)
    assert left.columns == frame.columns and left.count() == 161
    assert tox.without_toxic(frame, labels.limit(0)).count() == 201
    assert tox.without_toxic(frame.limit(0), labels).count() == 0


def test_url_parts_and_rules(spark):
    made = {
        "https://A.Example.NET/en/1?x=1": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://b.net": ("b.net", "", None, None),
        "http://b.net/q#/z": ("b.net", "/q", "net/", "block"),
        "http://notexample.com/de/1": ("notexample.com", "/de/1", None, None),
        "http://x.example.com/de/1": ("x.example.com", "/de/1", "example.com/de/", "block"),
        "http://w.org/fr/": ("w.org", "/fr/", "org/fr/", "allow"),
        "no scheme/en/": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
    }
    pages = spark.createDataFrame([(i, u, 1.0) for i, u in enumerate(made)], "page_id int, url string, entropy double")
    for frame in (pages, pages.where("url is null or url = ''")):
        for r in urls.judged(frame).collect():
            host, path, rule, verdict = list(made.values())[r.page_id]
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert r.verdict == verdict or verdict is None and r.verdict in ("allow", "block")
    assert urls.judged(pages.limit(0)).count() == 0


def test_quality(spark, docs, rows):
    labels = spark.createDataFrame([(0, 1), (12, 1), (9, 0), (10, 0), (5, 0)], "doc_id bigint, quality int")
    found = quality.scored(docs, labels)
    assert found.count() == len(rows)
    kept = {r.doc_id for r in found.where("kept").collect()}
    assert {0, 12} <= kept and not kept & {9, 10, 5}
    assert quality.scored(docs, labels.limit(0)).where("not kept").isEmpty()
    assert quality.scored(docs.limit(0), labels).count() == 0


def test_quality_rules(docs, rows):
    def repeats(own):
        at = defaultdict(list)
        for i in range(len(own) - 2):
            at[tuple(own[i : i + 3])].append(i)
        return len({i + k for p in at.values() if len(p) > 1 for i in p for k in range(3)})

    expected = []
    for r in rows:
        own, text = words(r[1]), r[1] or ""
        lines = [x for x in text.split("\n") if words(x)]
        expected.append(
            (r[0], len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text),
             len(lines) - len(set(lines)), repeats(own))
        )
    found = rules.judged(docs)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert bag(map(tuple, found.select(columns).collect())) == bag(expected)
    assert found.where("base_failed and kept").isEmpty()
    assert rules.judged(docs.limit(0)).count() == 0


def test_empty_tables(docs):
    none = docs.limit(0)
    for df in (repeated_bytes(none), repeated_words(none), near_duplicates(none), bpe.encoded(none)):
        assert df.count() == 0


def corpus():
    """Clean, toxic and copied texts, secrets and passages of ``ITEM`` beside the odd rows."""
    found = [(i, t) for i, t in enumerate(texts())]
    found += [found[0], (None, "lost words here"), found[4]]
    for i in range(100, 180):
        text = prose(i, 60) + (" vile" if i % 5 == 0 else "")
        if i % 7 == 0:
            text = f"Ünï {ITEM.upper()}; {text}"
        if i % 11 == 0:
            text += f" \napi_key = Zx81kkQ0pP{i}\nend É"
        found.append((i, text))
        if i % 13 == 0:
            found.append((i + 1000, text + " tail"))
    return [*found, (400, ITEM), (401, f"{ITEM}!"), (402, "see " + ITEM)]


ITEM = prose(4, 12)
#: Names that operators use for columns of their own, and one that has to be quoted.
CLASHES = ["_text", "_source", "_key", "_id", "_hash", "_hit", "_kept", "_items", "_redacted", "_toxic", "a.b"]


def cut(text, item):
    """``text`` without words inside a window of ``item``, from the first word to the last."""
    found = list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER)))
    own, parts = item.split(), [m[0] for m in found]
    windows = {tuple(own[i : i + 10]) for i in range(len(own) - 9)}
    hit = [False] * len(parts)
    for at in range(len(parts) - 9):
        if tuple(parts[at : at + 10]) in windows:
            hit[at : at + 10] = [True] * 10
    out, at, place = "", 0, 0
    while at < len(parts):
        end = at
        while end < len(parts) and hit[end]:
            end += 1
        if end > at:
            out, place = out + text[place : found[at].start()], found[end - 1].end()
        at = end + 1 if end == at else end
    return (out + text[place:] if any(hit) else text), any(hit)


def test_pipeline_equals_brute_force(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.public_tokenizers.path(bpe.TOKENIZER))
    made = corpus()
    # The number of characters is 7 where no stage changes the text.
    frame = spark.createDataFrame(
        [(i, t, "en", "s", 7, *([f"{i}"] * len(CLASHES))) for i, t in made],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        + ", ".join(f"`{c}` string" for c in CLASHES),
    )
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame(
        [(i, 1, int(i % 5 == 0)) for i in range(100, 180)], "doc_id bigint, quality int, toxic int"
    )
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench = spark.createDataFrame([(1, ITEM), (2, None)], "item_id bigint, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")

    model = tox.fit(frame, labels)
    left = [r for r in made if not model.scores(r[1])[3]]
    assert {i for i, _ in made} - {i for i, _ in left} >= {*range(100, 180, 5)}
    staying = {}
    for place, ((i, text), (_, n, component, _)) in enumerate(zip(left, components_of(left))):
        # Rows without a word all stay; groups without an id are told apart by their texts.
        group = (component,) if n and component is not None else (i, text) if n else place
        if group not in staying or (i is None, i or 0) < (staying[group][0] is None, staying[group][0] or 0):
            staying[group] = i, text
    expected = []
    for i, text in staying.values():
        new, hit = cut(text, ITEM)
        if hit and not words(new):
            continue
        new = sec.redact(new, sec.spans_of(new)) if new else new
        ids = library.encode(new or "", add_special_tokens=False).ids
        size = 7 if new == text else len(new)
        expected.append((i, new, "en", "s", size, struct.pack(f"<{len(ids)}I", *ids), len(ids)))
    assert any("REDACTED" in (r[1] or "") for r in expected) and not {400} & {r[0] for r in expected}

    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == [*frame.columns, "ids", "n_tokens"]
    kept = ["doc_id", "text", "lang", "source", "n_chars", "ids", "n_tokens"]
    found = [(*r[:5], bytes(r[5]), r[6]) for r in result.select(kept).collect()]
    assert bag(found) == bag(expected)
    assert result.where("not `a.b` <=> coalesce(string(doc_id), 'None')").isEmpty()


def test_pipeline_of_nothing(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids int"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.count() == 0 and dict(result.dtypes)["ids"] == "binary"


def test_pipeline(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (9, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    spark.createDataFrame([(1, prose(4, 12))], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert set(result.columns) >= {"doc_id", "text", "lang", "source", "n_chars", "ids", "n_tokens"}
    got = [r.doc_id for r in result.select("doc_id").collect()]
    assert got.count(0) == 1 and not {1, 2} & set(got) and 12 in got
    assert result.where(F.col("n_tokens") * 4 != F.octet_length("ids")).isEmpty()
