"""Write PLANS.md: the physical plans of the core operators, read after the
same query execution has run (AQE on, final adaptive plans), so the
partitioning, pruning and shuffle choices can be read without running
anything.

    python tools/plans.py [SF_DIR] [OUT]
"""

from __future__ import annotations

import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import numpy as np  # noqa: E402

from termflow.operators import dictionary as dct  # noqa: E402
from termflow.operators import blocks, evaluate, gd, selection, tf  # noqa: E402
from termflow.plans.catalog import MAIN  # noqa: E402
from termflow.plans.classify import pipeline  # noqa: E402
from termflow.session import build_session  # noqa: E402

NOTES = {
    "word count (AG1)": "Split/explode/lower/partial count in one codegen stage with the scan; one shuffle of "
                        "partially aggregated (word, count).",
    "dictionary ranking (DI1/DI2)": "TakeOrderedAndProject over the word counts; the row_number runs over at most "
                                    "K rows. (The pipeline cuts the counts at the exact threshold first.)",
    "TF build (JN1, AG2-AG4)": "Broadcast dictionary join in the scan stage; partial (doc, pos) count; shuffle on "
                               "(doc, pos); at most K pairs per document collected by doc_id.",
    "variance statistics (AG5-AG8)": "Stored TF read as pos and tf alone; partial central moments by pos, one small shuffle.",
    "gradient-descent pass (AG10)": "Packed blocks, coalesced; array operations on whole blocks; one K-vector a "
                                    "task, summed in a tree above 32 tasks.",
    "GD prediction (ML11)": "Batch by batch in the scan stage.",
    "ML vectors (FN13)": "Row by row: the Arrow-batched vector UDF.",
    "reduced ML vectors (FN14/ML5)": "Row by row, positions renumbered through a constant array; all-zero rows kept.",
    "confusion (AG11)": "One aggregation over the predictions.",
}


def final_plan(df) -> str:
    """The plan after running this very execution; long constants are cut."""
    df.toArrow()
    text = df._jdf.queryExecution().executedPlan().toString()
    return "\n".join(line if len(line) < 600 else line[:600] + " ..." for line in text.splitlines())


def main(sf_dir: str = "/root/testdata/sf0.01", out: str = str(ROOT / "PLANS.md")) -> None:
    spark = build_session("local[8]")
    p = pipeline(spark, sf_dir, MAIN)
    rows, k = p.rows("train"), p.size
    plans = {
        "word count (AG1)": dct.word_counts(p.corpus.train),
        "dictionary ranking (DI1/DI2)": dct.rank_dictionary(dct.word_counts(p.corpus.train), k),
        "TF build (JN1, AG2-AG4)": tf.tf_rows(p.corpus.train, p.dictionary, k),
        "variance statistics (AG5-AG8)": selection.feature_stats(rows, p.counts("train")[1]),
        "gradient-descent pass (AG10)": blocks.partial_sums(p.packed(), np.full(k, 0.01), 0.0, blocks.logistic,
                                                            gd.gradient_tasks(spark)),
        "GD prediction (ML11)": p.gd_predictions(),
        "ML vectors (FN13)": tf.tf_vectors(rows, k, "EN"),
        "reduced ML vectors (FN14/ML5)": tf.selected_vectors(rows, p.selected, p.m_size, "EN"),
        "confusion (AG11)": evaluate.confusion(p.gd_predictions()),
    }
    parts = ["# Physical plans\n",
             f"Generated by `tools/plans.py` on `{sf_dir}` with local[8], 8 shuffle partitions and AQE on. "
             "Each plan is the final adaptive plan after execution; constant arrays are cut at 600 characters.\n"]
    for name, df in plans.items():
        parts.append(f"## {name}\n\n{NOTES[name]}\n\n```\n{final_plan(df).rstrip()}\n```\n")
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    print("wrote", out)


if __name__ == "__main__":
    main(*sys.argv[1:])
