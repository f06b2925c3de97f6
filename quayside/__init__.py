"""quayside: a Spark-native audit-preparation engine.

Five independent trip/landing feeds are each pulled over a rolling window,
enriched through keyed, interval and validity lookups, stamped with fishing
years, a provenance-tagged trip id and a family of match keys, and written as
one refreshed table per feed.  Everything is DataFrame code planned by
Catalyst; see README.md for the layout.
"""

from quayside.context import RunContext, build_session

__all__ = ["RunContext", "build_session"]
