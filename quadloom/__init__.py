"""RDF quads as Spark DataFrames."""

from quadloom.model import Term, iri, lit

__all__ = ["Term", "iri", "lit"]
