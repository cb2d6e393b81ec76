from .expressions import *  # noqa: F401,F403
from .factors import *  # noqa: F401,F403
