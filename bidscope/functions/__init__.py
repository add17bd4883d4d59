"""Column builders (no UDFs): every scalar rule of the reports as a native expression."""

from bidscope.functions.exprs import *  # noqa: F401,F403
