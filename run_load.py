"""spark-submit launcher for one load (see wattlake/plans/job.py).

    spark-submit --py-files wattlake.zip run_load.py --landing ... --end 202101 --as-of 2021-01-02
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattlake.plans.job import main  # noqa: E402

if __name__ == "__main__":
    raise SystemExit(main())
