"""Work and recall of the vector searches on the given tables:

    python scripts/search_work.py [sf_dir ...]

For every directory: the share of list entries (chunks) and of rows
(embeddings) that the exact searches read, of all they would compare without
bounds; the recall at 5 of the quantised search, the length of its shortlist and
the share of full vectors it reads.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from pyspark.sql import functions as F

    from corpusflow.operators import blocks as B
    from corpusflow.operators import knowledge as K
    from corpusflow.operators import quantised as Q
    from corpusflow.plans import knowledge as P
    from corpusflow.session import local_session
    spark = local_session()
    for sf in sys.argv[1:] or ["/root/testdata/sf0.01"]:
        e, q = P.embeddings(spark, sf), P.questions(spark, sf, 64)
        _, work = B.topk(q, B.build(e, "pivots"), 5)
        read, held = work.agg(F.sum("read"), F.sum("held")).first()
        hits, length = Q.topk(q, Q.build(e), 5)
        exact = K.vector_topk(q, e, 5)
        n, asked = e.count(), q.count()
        recall = hits.join(exact, ["q_id", "c_id"], "left_semi").count() / exact.count()
        print(f"{sf}: {n} vectors, {asked} questions: exact search reads {read / held:.3f} of the rows; quantised search "
              f"recall {recall:.3f} with {length} of {n} full vectors a question ({length / n:.4f})", flush=True)
        if "check" not in sf:
            chunks, index = P.knowledge_base(spark, sf)
            _, work = B.topk(q, index, 5)
            read, held = work.agg(F.sum("read"), F.sum("held")).first()
            print(f"{sf}: {chunks.count()} chunks: inverted lists, {read / held:.3f} of the entries read", flush=True)


if __name__ == "__main__":
    main()
