"""Running one job per dataset."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from veiledlake.policy import DatasetPolicy


def for_each_dataset(
    policies: Iterable[DatasetPolicy], job: Callable[[DatasetPolicy], object], workers: int = 1
) -> dict[str, object]:
    """Run a job for every dataset and return what each gave, or the error it ended with.

    One dataset's failure does not stop the others. Use one worker when jobs
    add to a vault, which takes one writer at a time.
    """

    def guarded(policy: DatasetPolicy) -> object:
        try:
            return job(policy)
        except Exception as error:
            return error

    policies = list(policies)
    with ThreadPoolExecutor(workers) as pool:
        return dict(zip((p.table for p in policies), pool.map(guarded, policies), strict=True))
