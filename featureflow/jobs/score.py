"""Score raw fact + dimension files with saved feature parameters and a saved model.

    spark-submit -m featureflow.jobs.score --raw_flights 2008.csv.bz2 \\
        --raw_plane plane-data.csv --params PARAMS --model MODEL --out OUT
"""

from __future__ import annotations

from featureflow.jobs.common import PRESETS, base_parser, load_table, report, session
from featureflow.plans import features as feat
from featureflow.plans import model as mdl
from featureflow.sources import io


def main(argv=None):
    p = base_parser("Score new rows with saved preprocessing parameters and a saved model")
    p.add_argument("--raw_flights", required=True, help="fact table: CSV (glob, bz2) or Parquet")
    p.add_argument("--raw_plane", default=None, help="dimension table: CSV or Parquet")
    p.add_argument("--params", required=True, help="saved FeatureModel folder")
    p.add_argument("--model", required=True, help="saved PipelineModel folder, or a folder of them with --all")
    p.add_argument("--all", action="store_true", help="score every model under --model")
    p.add_argument("--out", required=True, help="output folder for predictions (CSV)")
    p.add_argument("--work", default=None, help="ingest cache folder for CSV inputs")
    p.add_argument("--metrics", default=None, help="output folder for the metrics (Parquet)")
    p.add_argument("--most_rejects", type=float, default=None,
                   help="with --work: keep malformed CSV records apart and fail above this share")
    args = p.parse_args(argv)
    spark = session(args, "featureflow-score")
    spec = PRESETS[args.preset]
    fact = load_table(spark, args.raw_flights, args.work, "fact", spec, args.most_rejects)
    dim = load_table(spark, args.raw_plane, args.work, "dim", spec) if args.raw_plane else None
    io.validate_dataset(fact, mode="predict")
    data = feat.preprocess_new(fact, dim, spec, feat.FeatureModel.load(args.params))
    if args.all:
        report(mdl.score_all_models(spark, args.model, data, spec.label, args.out), args.metrics)
    else:
        _, metrics = mdl.score(data, args.model, spec.label, args.out)
        if metrics is not None:
            report(metrics, args.metrics)


if __name__ == "__main__":
    main()
