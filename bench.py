"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads, BENCH_QUERIES a comma list of names.
Every query runs to completion into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "cell_stats gene_stats filter_cells_genes percent_pattern contingency log_normalise variable_genes_mvp "
    "downsample_per_label mean_expression flagship_markers markers_one_vs_rest population_mentions profile_correlation "
    "label_centroid_median order_by_pseudotime moving_average adaptive_moving_average resample_nearest trend_genes "
    "bh_adjust combat_gene_stats combat_apply simulate_doublets doublet_cluster_test voted_labels adjusted_rand_index "
    "adjusted_mutual_info knn snn gauss_graph paga diffusion_transition markers_pairwise diagonalise_genes minmax_by "
    "pseudotime_heatmap combat_solve pca scale_clip"
).split()


def main() -> None:
    from tools.check import session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = session(cpus)
    from catalogue.registry import QUERIES

    QUERIES["cell_stats"](spark, folder).write.format("noop").mode("overwrite").save()  # start the workers
    times = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    line = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": folder.rsplit("sf", 1)[-1]}
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
