from rivulet.operators import etl, reports, rides  # noqa: F401
from rivulet.operators.ip_tally import range_blocks, tally_ranges  # noqa: F401
from rivulet.operators.lake import LakeTable, apply_changes_anti, latest_per_key  # noqa: F401
