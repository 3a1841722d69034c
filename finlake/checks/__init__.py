from finlake.checks import core, marts, models, payloads, lakes  # noqa: F401
from finlake.checks.registry import CHECKS  # noqa: F401
