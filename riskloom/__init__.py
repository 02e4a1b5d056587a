"""riskloom: profiling, cleaning, modelling and scoring of labelled tables on Spark."""

from riskloom.spec import RoleSpec, STUDENTS, normalise, validate

__all__ = ["RoleSpec", "STUDENTS", "normalise", "validate"]
