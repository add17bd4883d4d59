"""bidscope: ad-exchange funnel reports as Spark DataFrame plans.

Raw bid request / response / win / click / page-track tables go in; a
response-grain fact and about forty report tables come out.  Every table is
a lazily planned ``DataFrame``; nothing on the data path runs on the driver.
"""

from bidscope.plans.request import FunnelRequest, Rules

__all__ = ["FunnelRequest", "Rules"]
