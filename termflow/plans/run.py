"""Command-line runs over two document-line corpora, the way the reference's
scripts are submitted:

    spark-submit termflow/plans/run.py gd  TRAIN TEST LR ITERATIONS REG OUT
    spark-submit termflow/plans/run.py ml  {lr,svm} {full,reduced} TRAIN TEST
    (or: python -m termflow.plans.run ...)

``gd`` writes the cost history as one CSV part file to OUT and shows the top
words, the confusion counts, F1 and the texts of up to three false-positive ids; ``ml``
shows the confusion matrix, accuracy, precision / recall / F-measure of class
1 and the phase times. Reports are DataFrames; ``show`` prints them.
"""

from __future__ import annotations

import argparse
import os
import sys

if not __package__:  # run as a script (spark-submit path/to/run.py): put the repo root on the path
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession

from termflow import params
from termflow.operators import evaluate, gd
from termflow.plans.classify import Preset, line_report, metrics_frame, pipeline_from_lines, timed_run
from termflow.session import materialize, scratch_path
from termflow.sources import sinks


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="termflow.plans.run")
    ap.add_argument("--k", type=int, default=params.DICTIONARY_SIZE, help="dictionary size")
    ap.add_argument("--m", type=int, default=params.SELECTED_FEATURES, help="selected features")
    ap.add_argument("--prefix", default=params.REFERENCE_LABEL_PREFIX, help="label-1 id prefix")
    ap.add_argument("--parse-mode", default="FAILFAST", choices=("FAILFAST", "DROPMALFORMED"))
    ap.add_argument("--rejects", default=None,
                    help="new folder for the lines that DROPMALFORMED leaves out (default: the checkpoint folder)")
    sub = ap.add_subparsers(dest="command", required=True)
    g = sub.add_parser("gd", help="gradient-descent logistic regression")
    g.add_argument("train")
    g.add_argument("test")
    g.add_argument("learning_rate", type=float)
    g.add_argument("iterations", type=int)
    g.add_argument("reg", type=float)
    g.add_argument("out")
    g.add_argument("--tol", type=float, default=params.GD_TOLERANCE)
    g.add_argument("--report", default=None,
                   help="new folder for the false positives' texts (default: the checkpoint folder)")
    g.add_argument("--log", default=None, help="folder of the descent's steps; a run cut off goes on from there")
    m = sub.add_parser("ml", help="Spark ML logistic regression or linear SVM")
    m.add_argument("model", choices=("lr", "svm"))
    m.add_argument("features", choices=("full", "reduced"))
    m.add_argument("train")
    m.add_argument("test")
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    if args.command == "gd":
        preset = Preset(k=args.k, m=args.m, prefix=args.prefix, learning_rate=args.learning_rate,
                        iterations=args.iterations, reg=args.reg, tol=args.tol)
    else:
        preset = Preset(k=args.k, m=args.m, prefix=args.prefix)
    p = pipeline_from_lines(spark, args.train, args.test, preset, args.parse_mode, args.rejects)
    out: dict = {}
    if p.corpus.quarantine:
        out["lines"] = line_report(spark, p.corpus)
    if args.command == "gd":
        model = p.gd_model(log=args.log)
        history = sinks.history_frame(spark, model.history)
        sinks.write_single_file(history, args.out)
        preds = materialize(p.gd_predictions())
        report = args.report or scratch_path(spark, "false-positives")
        conf = evaluate.confusion(preds)
        out |= {"history": history, "top_words": gd.top_words(spark, model, p.dictionary),
                "confusion": conf, "f1": evaluate.f1_report(conf),
                "false_positives": sinks.write_report(evaluate.false_positives(preds, p.corpus.test), report)}
    else:
        out["metrics"] = metrics_frame(spark, [timed_run(p, args.model, args.features)], with_timing=True)
    for name, df in out.items():
        print(f"== {name}")
        if name == "false_positives":  # up to three ids, but any number of texts
            print(f"written to {report}")
            for number, page in enumerate(sinks.pages(df), 1):
                print(f"-- page {number}")
                for row in page:
                    print(f"{row['doc_id']}\t{row['text']}")
        else:
            df.show(max(df.count(), 1), truncate=False)
    return out


if __name__ == "__main__":
    main()
