"""spark-submit entry for the whole job.

    spark-submit --py-files rankbeam.zip scripts/run_job.py RAW_DIR OUT_DIR [--stages ...]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rankbeam.plans.job import main  # noqa: E402

if __name__ == "__main__":
    main()
