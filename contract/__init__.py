"""Queries over the driver tables, each with the SQL that must give the same rows.

The tables have no load logs or feed configuration, so every query first shapes
them into the input its operator expects (an event as one load, a line item as a
row of a staged file, and so on) and then runs the operator over all of them.
"""

from contract import config, observe, staging, streams

QUERIES = {**observe.QUERIES, **config.QUERIES, **staging.QUERIES, **streams.QUERIES}
ORACLES = {**observe.ORACLES, **config.ORACLES, **staging.ORACLES, **streams.ORACLES}
