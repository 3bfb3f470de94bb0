"""Job entry points for ``spark-submit`` (C2): ``python -m meterwise <job> ...``.

Each job builds its session here and hands it to library functions; connection
secrets come from the environment (C1), never from the command line.
"""

from __future__ import annotations

import argparse

from meterwise import config
from meterwise.plans import jobs
from meterwise.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="meterwise")
    sub = parser.add_subparsers(dest="job", required=True)

    load = sub.add_parser("load", help="CSV -> schema -> drop incomplete -> Parquet (-> documents)")
    load.add_argument("csv")
    load.add_argument("parquet")
    load.add_argument("--by-month", action="store_true", help="year/month folder layout")
    load.add_argument("--documents", metavar="HOST/DB.COLLECTION", help="also append to a collection")

    ana = sub.add_parser("analyze", help="monthly means by tariff, saved as Parquet")
    ana.add_argument("parquet")
    ana.add_argument("out")
    ana.add_argument("--documents", metavar="HOST/DB.COLLECTION")

    wc = sub.add_parser("wordcount", help="text -> (word, count) as CSV and pair text")
    wc.add_argument("text")
    wc.add_argument("out_csv")
    wc.add_argument("--pairs")
    wc.add_argument("--documents", metavar="HOST/DB.COLLECTION")

    exp = sub.add_parser("export", help="staged Parquet -> count -> document collection")
    exp.add_argument("parquet")
    exp.add_argument("documents", metavar="HOST/DB.COLLECTION")
    exp.add_argument("--format", default="mongodb", help="connector format name")

    ppl = sub.add_parser("people", help="JSON -> Parquet -> teenagers by SQL -> CSV")
    ppl.add_argument("json")
    ppl.add_argument("parquet")
    ppl.add_argument("out_csv")

    ap = parser.parse_args(argv)
    spark = build_session(f"meterwise-{ap.job}")

    def doc_options(target: str | None):
        if not target:
            return None
        host, rest = target.split("/", 1)
        db, coll = rest.split(".", 1)
        return config.document_store_options(host, db, coll)

    try:
        if ap.job == "load":
            staged = jobs.load_readings(spark, ap.csv, ap.parquet, partition_by_month=ap.by_month,
                                        document_options=doc_options(ap.documents))
            staged.show()
        elif ap.job == "analyze":
            jobs.analysis_job(spark, ap.parquet, ap.out, doc_options(ap.documents)).show()
        elif ap.job == "wordcount":
            jobs.word_count_job(spark, ap.text, ap.out_csv, ap.pairs,
                                doc_options(ap.documents)).show()
        elif ap.job == "export":
            n = jobs.export_documents(spark, ap.parquet, doc_options(ap.documents),
                                      document_format=ap.format)
            print(f"{n} rows sent")
        elif ap.job == "people":
            jobs.people_job(spark, ap.json, ap.parquet, ap.out_csv).show()
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
