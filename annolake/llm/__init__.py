"""Operators for preparing large text corpora; `entry` holds their registered queries."""
