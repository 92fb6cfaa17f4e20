"""Print the formatted physical plan (and optionally time) registered queries.

Usage: python tools/explain.py CATALOG_DIR SF_DIR name [name ...] [--run]

CATALOG_DIR is a stored catalog (created from SF_DIR when missing).
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv: list[str]) -> None:
    from cadenza.plans.registry import registry
    from cadenza.session import build_session
    from cadenza.sources.files import load_catalog, save_catalog
    from cadenza.sources.testdata import from_testdata, read_sources

    run = "--run" in argv
    args = [a for a in argv[1:] if a != "--run"]
    store, sf_dir, names = args[0], args[1], args[2:]
    spark = build_session("local[8]", shuffle_partitions=16)
    if not os.path.exists(os.path.join(store, "users")):
        save_catalog(from_testdata(spark, sf_dir), store)
    cat = load_catalog(spark, store).with_sources(read_sources(spark, sf_dir))
    reg = registry()
    for name in names:
        df = reg[name].build(cat)
        print(f"===== {name}")
        df.explain("formatted")
        if run:
            for _ in range(2):
                t = time.perf_counter()
                df.write.format("noop").mode("overwrite").save()
                print(f"{name}: {time.perf_counter() - t:.3f}s")


if __name__ == "__main__":
    main(sys.argv)
