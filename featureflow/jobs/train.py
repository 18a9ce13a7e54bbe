"""Model selection on a feature table, then scoring of the test table."""

from __future__ import annotations

from featureflow.jobs.common import PRESETS, base_parser, report, session
from featureflow.plans import model as mdl
from featureflow.plans.features import read_feature_table
from featureflow.sources import io


def main(argv=None):
    p = base_parser("Cross-validated model selection; retrained best models are saved and scored")
    p.add_argument("--features", required=True, help="folder with features.parquet (partitions is_train=true and false)")
    p.add_argument("--models", required=True, help="folder for retrained_<family> models")
    p.add_argument("--predictions", default=None, help="folder for prediction CSVs")
    p.add_argument("--families", default=",".join(mdl.FAMILIES))
    p.add_argument("--folds", type=int, default=5)
    p.add_argument("--parallelism", type=int, default=None)
    p.add_argument("--skip_training", action="store_true")
    p.add_argument("--debug", action="store_true", help="train on a 10 %% sample")
    p.add_argument("--metrics", default=None, help="output folder for the metrics (Parquet)")
    args = p.parse_args(argv)
    spark = session(args, "featureflow-train")
    label = PRESETS[args.preset].label
    train, test = read_feature_table(spark, args.features)
    io.validate_dataset(train, label)
    if args.debug:
        train = train.sample(fraction=0.1, seed=42)
    if not args.skip_training:
        metrics, _ = mdl.train_select(train, label, families=tuple(args.families.split(",")), folds=args.folds,
                                      parallelism=args.parallelism, save_dir=args.models)
        report(metrics, args.metrics and f"{args.metrics}/selection")
    report(mdl.score_all_models(spark, args.models, test, label, args.predictions),
           args.metrics and f"{args.metrics}/test")


if __name__ == "__main__":
    main()
