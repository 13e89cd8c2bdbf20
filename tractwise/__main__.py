"""Run one step of the analysis.

    spark-submit --py-files tractwise.zip -m tractwise tables --source census --states state_fips.csv
    python -m tractwise models --models /shared/models
    python -m tractwise inputs --models /shared/models
    python -m tractwise importance --models /shared/models
    python -m tractwise impact --models /shared/models --state CA
    python -m tractwise scenarios --models /shared/models --state CA
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tractwise.plans import job


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tractwise", description=__doc__.splitlines()[0])
    parser.add_argument(
        "step", choices=["tables", "models", "inputs", "importance", "impact", "scenarios"]
    )
    parser.add_argument("--source", help="schema of the census tables")
    parser.add_argument("--states", help="CSV of state, postal_code, fips")
    parser.add_argument("--models", help="shared folder of the stored models")
    parser.add_argument("--staging", default="staging")
    parser.add_argument("--curated", default="curated")
    parser.add_argument("--buckets", type=int, help="store income changes in this many buckets")
    parser.add_argument("--state", help="restrict a report to one state")
    parser.add_argument("--rows", type=int, default=20, help="rows of a report to show; all are stored")
    parser.add_argument("--export", help="folder for the importance tables as CSV")
    given = parser.parse_args(arguments)
    needed = ("source", "states") if given.step == "tables" else ("models",)
    for name in needed:
        if getattr(given, name) is None:
            parser.error(f"{given.step} needs --{name}")

    spark = SparkSession.builder.appName(f"tractwise {given.step}").getOrCreate()
    if given.step == "tables":
        job.build_tables(
            spark, given.source, given.states, stage=given.staging, curated=given.curated,
            buckets=given.buckets,
        )
    elif given.step in ("impact", "scenarios"):
        report = job.impact_report if given.step == "impact" else job.scenario_report
        report(spark, given.models, stage=given.staging, state=given.state).show(
            given.rows, truncate=False
        )
    else:
        step = {
            "models": job.build_models, "inputs": job.build_inputs,
            "importance": job.build_importance,
        }[given.step]
        more = {"export": given.export} if given.step == "importance" else {}
        step(spark, given.models, stage=given.staging, **more)


if __name__ == "__main__":
    main()
