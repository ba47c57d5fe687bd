import corpus_pipeline

from laketide.llm import bpe


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.columns
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf)
        if name != "bpe":
            assert made.columns == before, name
        docs = spark.createDataFrame(made.collect(), made.schema)
        counts.append(docs.count())
    assert counts[0] < 200 and counts[2] <= counts[1] == counts[0] and counts[3] >= counts[2]
    rows = docs.collect()
    assert all(r.n_tokens * 4 == len(r.ids) for r in rows) and bpe.PATTERN


def test_near_and_token_rows(spark, sf):
    """Rows of the stages at the settings of production, against brute
    force: what near-dedup keeps (5 words, 0.8) and what the ids decode to."""
    from test_operators import components
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start = docs.collect()
    # copies that differ in one word, above and below the threshold
    words = [f"w{i}" for i in range(60)]
    near = [" ".join([*words[:i], "new", *words[i + 1:]]) for i in (0, 30)]
    near += [" ".join([*words[:20], *[f"v{i}" for i in range(k)], *words[20 + k:]]) for k in (3, 20)]
    extra = [{**start[0].asDict(), "doc_id": 10**9 + i, "text": t} for i, t in enumerate(near)]
    docs = docs.unionByName(spark.createDataFrame([tuple(e[c] for c in docs.columns) for e in extra], docs.schema))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    kept = [d for d, _, _, keep in components(rows, 5, 80) if keep]
    made = stages["near_dedup"](spark, docs, sf)
    assert made.columns == docs.columns and len(kept) < len(rows)
    assert sorted(r.doc_id for r in made.select("doc_id").collect()) == sorted(kept)

    import base64
    import public_tokenizers
    from laketide.llm.queries import VOCABULARY
    piece = {}
    with open(public_tokenizers.path(VOCABULARY)) as f:
        for line in f:
            token, rank = line.split()
            piece[int(rank)] = base64.b64decode(token)
    texts = dict(rows)
    for r in stages["bpe"](spark, docs, sf).select("doc_id", "ids").collect():
        ids = [int.from_bytes(r.ids[i:i + 4], "little") for i in range(0, len(r.ids), 4)]
        assert b"".join(piece[i] for i in ids).decode() == (texts[r.doc_id] or "")


def test_oracles(spark, sf):
    import duckdb
    from laketide.llm import oracle, queries
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, sql in oracle.SQL.items():
        df = queries.QUERIES[name](spark, sf)
        cols = ", ".join(df.columns)
        want = con.sql(f"select {cols} from ({sql})").fetchall()
        assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str), name
