"""Warehouse transforms, joins and checks as DataFrame operators."""
