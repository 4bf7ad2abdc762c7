"""Reusable physical shapes: the blocked sequence plan and the query registry."""
