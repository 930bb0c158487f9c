"""The pipeline, the registered queries and their SQL."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from barlake.llm import queries, toxicity
from tests.llm import test_decontamination, test_jaccard, test_suffixes
from tests.llm.test_mixing import plain_targets


SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_has_its_query():
    names = entry.queries()
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries_return_their_rows(spark, name):
    df = queries.queries()[name](spark, SF_DIR)
    table = {"op4_chat": "conversations", "op5_warc": "pages"}.get(name, "documents")
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    if name == "pipeline":
        assert 0 < df.count() <= rows
    elif name == "op13_prefix_trie":
        # A row for each node: one root, of which all conversations are members.
        conversations = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id").distinct()
        (root,) = df.filter("depth = 0").collect()
        assert root.n_convs == conversations.count() and df.count() > root.n_children
    else:
        assert df.count() == rows


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*COLUMNS)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "jaccard", "suffixes", "decontamination", "mixing"]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "mixing":
            assert out.columns == COLUMNS and out.dtypes == docs.dtypes
            docs = spark.createDataFrame(out.collect(), out.schema)
        counts.append(out.count())
        assert 0 < counts[-1] <= counts[-2]
    assert all(r.copies >= 1 for r in out.select("copies").collect())
    # Nothing that is left is a near copy, a repeat or a test item.
    from barlake.llm.decontamination import decontaminate
    from barlake.llm.jaccard import link_documents
    from barlake.llm.suffixes import remove_repeated_substrings

    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert decontaminate(docs, items).filter("_hits > 0").isEmpty()
    assert remove_repeated_substrings(docs).filter("size(_removed) > 0").count() <= 2
    linked = link_documents(docs).filter("n_shingles > 5 AND n_links > 0").count()
    assert linked <= 0.02 * counts[0]


def test_clean_documents_go_through_unchanged(spark):
    rows = [(i, " ".join(f"only{i}word{j}" for j in range(80)), "en", "s", None) for i in range(20)]
    rows += [(100, None, None, None, None), (101, "", "en", None, 0)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*COLUMNS).schema)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF_DIR)
        assert {(r.doc_id, r.text) for r in docs.collect()} == {r[:2] for r in rows}


def plain_cut(text, items):
    """The text without its runs of hit words, and whether it stays."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    spans = [m.span() for m in re.finditer(word, text.translate(test_decontamination.LOWER))]
    words, hit = test_decontamination.words(text), [False] * len(spans)
    for item in items:
        n = min(10, len(item))
        windows = {tuple(item[j : j + n]) for j in range(len(item) - n + 1 if n else 0)}
        for j in range(len(words) - n + 1 if n else 0):
            if tuple(words[j : j + n]) in windows:
                hit[j : j + n] = [True] * n
    out, upto = "", 0
    for j, h in enumerate(hit):
        if h and (j == 0 or not hit[j - 1]):
            out += text[upto : spans[j][0]]
        if h:
            upto = spans[j][1]
    return out + text[upto:], sum(hit) <= 0.5 * len(words)


def plain_mix(rows):
    """Copies by id from ``(doc_id, source, words, hash)``."""
    by, copies = {}, {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    sizes = {s: sum(r[2] for r in rs) for s, rs in by.items()}
    targets = plain_targets(sizes, (3, 1, 2), 1.5, 2.0)
    for s, rs in by.items():
        each = targets[s] / sizes[s]
        whole, p = int(each), each - int(each)
        want, seen = targets[s] - whole * sizes[s], 0

        def odds(r):
            u = (((r[3] % (1 << 64)) >> 11) + 0.5) / (1 << 53)
            return (u / (1 - u) * (1 - p) / p if p else 0, r[3])

        for r in sorted(rs, key=odds):
            copies[r[0]] = whole + (p > 0 and seen + r[2] / 2 <= want)
            seen += r[2]
    return {i: n for i, n in copies.items() if n}


def test_stages_against_a_plain_pipeline(spark):
    """Ids, texts and copies after each stage, exactly; the scores of toxicity are given."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*COLUMNS)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").filter(toxicity.learnt_from(F.col("doc_id")))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    items = [test_decontamination.words(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = {r.doc_id: r.text for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    assert len(want) == docs.count() and None not in want
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR).collect()
        if name == "toxicity":
            want = {i: t for i, t in want.items() if scores[i] < 0.7}
        elif name == "jaccard":
            groups = test_jaccard.plain(list(want.items()), 5, 80)
            want = {i: want[i] for i, _, component, _ in groups if i == component}
        elif name == "suffixes":
            cut = test_suffixes.plain(list(want.items()), 200)
            want = {i: kept.decode(errors="ignore") for i, _, kept, _ in cut}
        elif name == "decontamination":
            cut = {i: plain_cut(t, items) for i, t in want.items()}
            want = {i: t for i, (t, stays) in cut.items() if stays}
        else:
            hashes = docs.select("doc_id", F.xxhash64(F.lit(0), "doc_id", "text").alias("h")).collect()
            hashes = {r.doc_id: r.h for r in hashes}
            words = {i: len(re.findall(r"[^ \t-\r]+", t)) for i, t in want.items()}
            copies = plain_mix([(i, source[i], words[i], hashes[i]) for i in want])
            assert {r.doc_id: r.copies for r in out} == copies
            want = {i: want[i] for i in copies}
        got = {r.doc_id: r.text for r in out}
        assert len(out) == len(got) and got.keys() == want.keys(), name
        assert not [(name, i, got[i], want[i]) for i in got if got[i] != want[i]]
        assert name == "mixing" or all(r.n_chars == len(r.text) for r in out)
        docs = spark.createDataFrame([tuple(r)[:5] for r in out], docs.schema)


def test_further_columns_of_any_name_are_carried(spark, tmp_path):
    """Also under names that stages use themselves; the added ones are replaced."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*COLUMNS)
    names = ["_row", "_score", "_kept", "_removed", "_hits", "chunk", "size", "set", "target", "Copies", "taken"]
    docs = docs.withColumns({c: F.concat(F.lit(c), docs["doc_id"].cast("string")) for c in names})
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        carried = [c for c in names if name != "mixing" or c not in ("Copies", "taken")]
        assert out.columns == COLUMNS + carried + ["copies", "taken"] * (name == "mixing")
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        rows = docs.collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in carried)
    # A row stands for all its copies: by them the words come to the target of their source.
    words = {}
    for r in rows:
        assert r.taken == r.copies * len((r.text or "").split())
        words[r.source] = words.get(r.source, 0) + r.taken
    sizes = {}
    for r in spark.read.parquet(f"{tmp_path}/3").collect():
        sizes.setdefault(r.source, []).append(len((r.text or "").split()))
    targets = plain_targets({s: sum(n) for s, n in sizes.items()}, (3, 1, 2), 1.5, 2.0)
    assert all(abs(words.get(s, 0) - targets[s]) <= max(n) / 2 + 1e-6 for s, n in sizes.items())


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*COLUMNS).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).collect() == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(want.columns)
    got = got.select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
