"""Registered queries with their reference SQL."""

from itemforge.plans import bank, layouts, merging, records, relational, repairs, sequences, streams, structure, texts, uploads, varied, workspace
from itemforge.plans.registry import ORACLES, QUERIES
