"""Print Spark's formatted physical plan of registered queries.

    python tools/explain_plans.py /root/testdata/sf0.01 corpus_sliding doc_scores

Training queries run their epochs while the DataFrame is being built; their
plans show only the final (small) result.
"""

from __future__ import annotations

import sys

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from charloom.queries import QUERIES
    from charloom.session import get_spark
    spark = get_spark()
    for name in sys.argv[2:] or QUERIES:
        print("=" * 30, name)
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
