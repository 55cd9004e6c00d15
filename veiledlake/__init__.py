"""De-identifying incremental curation on Spark.

Change-data rows plus a policy per dataset become de-identified rows with
stable tokens, and then one current row per primary key.
"""

from veiledlake.functions.tokens import KeyedTokens
from veiledlake.plans.clean import clean, run_clean
from veiledlake.plans.curate import curate, run_curate
from veiledlake.policy import DatasetPolicy, PolicyError

__all__ = [
    "DatasetPolicy",
    "KeyedTokens",
    "PolicyError",
    "clean",
    "curate",
    "run_clean",
    "run_curate",
]
