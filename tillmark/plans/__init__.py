"""Contracts, stored-model layout, registered queries and their oracle SQL."""
