"""Shared by the tests: data directories and tiny ACE tables."""

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def ace_df(spark, rows):
    """Tiny ACE frame: rows of (folder, name, sid, mask[, inherited[, raw]])."""
    full = []
    for r in rows:
        r = list(r) + [None] * (6 - len(r))
        if r[4] is None:
            r[4] = False
        full.append(tuple(r))
    return spark.createDataFrame(full, "folder_path string, ace_name string, ace_sid string, ace_mask string, "
                                       "ace_inherited boolean, ace_raw string")
