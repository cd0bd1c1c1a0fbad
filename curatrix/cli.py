"""Command line: a stage (status, qc, dedup, screen, caption, balance and so on) or any query of the catalogue over a folder of tables."""

from __future__ import annotations

import argparse

from curatrix.session import build_session


def main(argv: list[str] | None = None) -> int:
    from curatrix.plans import catalogue

    stages = {
        "status": "q_status_pivot", "distribution": "q_distributions", "qc": "q_quality_reasons", "downscale": "q_downscale_dims", "dedup": "q_near_duplicate_components", "keep": "q_keep_best",
        "screen": "q_screening", "validate": "q_vocabulary_dimensions", "caption": "q_assemble_dense", "balance": "q_balance_repeats", "export": "q_curated_top_n",
    }
    p = argparse.ArgumentParser(prog="curatrix", description=__doc__)
    p.add_argument("command", choices=[*stages, "query", "list"])
    p.add_argument("--data", default=".", help="folder with the Parquet tables")
    p.add_argument("--name", help="query to run")
    p.add_argument("--out", help="folder to write the result to; shown if absent")
    p.add_argument("--master", default="local[*]")
    a = p.parse_args(argv)
    if a.command == "list":
        print("\n".join(sorted(catalogue.QUERIES)))
        return 0
    name = stages.get(a.command, a.name)
    if name not in catalogue.QUERIES:
        p.error(f"no such query: {name}")
    df = catalogue.QUERIES[name](build_session(a.master), a.data)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
