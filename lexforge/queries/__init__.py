"""Queries over the given tables, one or more per operator, each with its SQL equivalent."""

from lexforge.queries import components, crossing, dictionary, exports, ranks, readings, roundtrips, symbols, tables, wordforms

ALL = {}
for module in (ranks, dictionary, symbols, readings, tables, crossing, exports, roundtrips, components, wordforms):
    ALL |= module.QUERIES
