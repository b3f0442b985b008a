"""Spreading a small scan over all cores."""

from pyspark.sql import DataFrame

WAVES = 2


def spread_scan(scan: DataFrame) -> DataFrame:
    """Repartition a file scan that has too few splits to occupy the cluster.

    Splitting words costs far more than reading them, and a file with a single
    row group is one task however many cores there are. A scan that already has
    at least two splits per core, as any large one does, is left as it is: no
    shuffle of the texts. Only for plain scans, whose number of splits is known
    without running a job.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= WAVES * cores:
        return scan
    return scan.repartition(WAVES * cores)
