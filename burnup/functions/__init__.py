from burnup.functions.expr import *  # noqa: F401,F403
