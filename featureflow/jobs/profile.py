"""Exploratory profile: write the tables behind every chart."""

from __future__ import annotations

from featureflow.jobs.common import PRESETS, base_parser, load_table, session
from featureflow.plans import profile as prof
from featureflow.sources import io


def main(argv=None):
    p = base_parser("Profile the joined, typed table with all its rows and identifiers")
    p.add_argument("--raw_flights", required=True)
    p.add_argument("--raw_plane", default=None)
    p.add_argument("--out", required=True)
    p.add_argument("--years", default="Year,PlaneIssueYear", help="categories that are profiled as numbers")
    p.add_argument("--format", choices=["parquet", "csv"], default="csv")
    args = p.parse_args(argv)
    spark = session(args, "featureflow-profile")
    spec = PRESETS[args.preset]
    fact = load_table(spark, args.raw_flights, f"{args.out}/ingest", "fact", spec)
    dim = load_table(spark, args.raw_plane, f"{args.out}/ingest", "dim", spec) if args.raw_plane else None
    io.validate_dataset(fact, spec.label)
    years = [c for c in spec.nominal if c in args.years.split(",")]
    df = prof.profile_frame(fact, dim, spec, years)
    numeric = spec.quantitative_out + [c.name for c in spec.cyclic] + years
    categorical = [c for c in (*spec.nominal, *spec.useless) if c not in years]
    tables = prof.profile(df, numeric, categorical, spec.label,
                          mean_top_k_features=[c for c in categorical if c in ("Origin", "Dest", "Model")],
                          mean_numeric_features=numeric)
    prof.write_profile(tables, args.out, args.format)


if __name__ == "__main__":
    main()
