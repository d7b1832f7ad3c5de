"""The SQL counterparts on tables with repeated ids, nulls and vectors with null components, against plain Python."""

import hashlib

import duckdb

from postsift.llm.oracles import LLM_SQL
from tests.llm import test_lines as lines
from tests.llm import test_vectors as vectors


def run(sql, create, rows):
    con = duckdb.connect()
    con.execute(create)
    con.executemany(f"insert into {create.split()[2].split('(')[0]} values ({', '.join('?' * len(rows[0]))})", rows)
    return con.execute(sql).fetchall()


def test_lines():
    got = run(LLM_SQL["op1_line_dedup"], "create table documents(doc_id bigint, text varchar)", lines.ROWS)
    want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, kept, n, gone in lines.plain(lines.ROWS, 40, 5)]
    assert sorted(got, key=str) == sorted(want, key=str)


ROWS = [(i, [float(i % 7), 1.0, -0.5 * (i % 3)], i % 2) for i in range(1, 40)]
ROWS += [(100, [1.0, 2.0, 3.0], 1), (100, [1.0, 2.0, 3.0], 1), (100, [3.0, 2.0, 1.0], 0), (7, ROWS[6][1], 1)]
ROWS += [(200, None, 1), (300, [1.0, None, 2.0], 1), (400, [], 0), (None, [1.0, 1.0, 1.0], 1), (500, [0.0, 0.0, 0.0], 1), (600, [1.0, 2.0], None)]
TABLE = "create table embeddings(vec_id bigint, embedding float[], label int)"


def test_top_k():
    want = vectors.plain_top(ROWS, lambda i: i % 100 == 0, 10)
    assert sorted(run(LLM_SQL["op6_top_k"], TABLE, ROWS)) == want and len(want) == 40  # four query rows with a partner, ten ranks each


def test_near_vectors():
    got = [(i, n, c, True if k is None else k) for i, n, c, k in run(LLM_SQL["op4_near_vectors"], TABLE, ROWS)]
    assert sorted(got, key=str) == vectors.plain_near(ROWS, 0.98)
