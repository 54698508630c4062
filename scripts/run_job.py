"""spark-submit entry for the batch job: ``spark-submit scripts/run_job.py --raw-dir ... --output-dir ...``."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from assetlife.plans.job import main  # noqa: E402

if __name__ == "__main__":
    raise SystemExit(main())
