"""Session contract: the cluster profile and the checkpoint folder come from the session, checked in a fresh
process so the shared test session keeps its settings."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cluster_profile_and_checkpoint_dir(scratch):
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from strata.session import get_session, checkpoint_root, scratch_dir
        spark = get_session(master="local[1]", profile="cluster",
                            conf={{"spark.checkpoint.dir": {scratch + "/shared"!r}}})
        print("PARTS", spark.conf.get("spark.sql.shuffle.partitions"))
        print("SPLIT", spark.conf.get("spark.sql.files.maxPartitionBytes"))
        print("TZ", spark.conf.get("spark.sql.session.timeZone"))
        print("CKPT", "/shared" in checkpoint_root(spark))  # Spark adds a per-application subfolder
        print("SCRATCH", scratch_dir(spark, "x").startswith(checkpoint_root(spark)))
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                         check=True).stdout
    lines = dict(line.split(" ", 1) for line in out.splitlines() if " " in line)
    assert lines["PARTS"] == "4000" and lines["SPLIT"] in ("512m", "536870912b", "536870912")
    assert lines["TZ"] == "UTC" and lines["CKPT"] == "True" and lines["SCRATCH"] == "True"
