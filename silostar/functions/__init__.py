from silostar.functions.columns import *  # noqa: F401,F403
from silostar.functions.display import *  # noqa: F401,F403
