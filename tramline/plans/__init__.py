"""The catalogue of queries, each with its SQL where SQL can express it."""

from tramline.plans import feeds, scheduled, serving, transit

ALL = transit.QUERIES | scheduled.QUERIES | feeds.QUERIES | serving.QUERIES
