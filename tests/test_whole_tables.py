"""Queries count every row, whatever its stored size and however its source is spelled."""

import pyarrow as pa
import pyarrow.parquet as pq

from corpusmill import queries as core
from corpusmill.operators import chunks


def test_bestfit_crop_counts_every_text(spark, tmp_path):
    texts = ["Mati je pela.", "Kdo je tam? " * 5, "Vlak stal.", None, ""]
    rows = {"chunk_id": range(5), "url": ["u"] * 5, "chunk_index": range(5), "text": texts, "n_tokens": [None, 7, 10**6, 3, None]}
    pq.write_table(pa.table({k: list(v) for k, v in rows.items()}), tmp_path / "chunk_doc.parquet")
    encode = chunks.encoder().encode_ordinary
    got = core.queries()["bestfit_crop"](spark, str(tmp_path)).agg({"total": "sum", "cropped": "sum"}).first()
    assert got["sum(total)"] == sum(len(encode(t or "")) + 1 for t in texts) and got["sum(cropped)"] == 0


def test_crawl_skip_counts_takes_every_spelling(spark, tmp_path):
    sources = ["wikivir", "WIKIVIR", "Wikivir", "wiki-vir", " wiki_vir ", "wikipedia", None]
    n = len(sources)
    pq.write_table(pa.table({"row_id": list(range(n)), "source": sources, "title": ["Pesem"] * n, "text": ["Mati je pela. " * 90] * n, "author": ["Ana Bor"] * n}), tmp_path / "corpus_doc.parquet")
    pq.write_table(pa.table({"name": ["Ana Bor"]}), tmp_path / "author_cfg.parquet")
    assert sum(r["n"] for r in core.queries()["crawl_skip_counts"](spark, str(tmp_path)).collect()) == 5
