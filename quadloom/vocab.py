"""Public W3C vocabulary IRIs and the library's own reserved IRIs."""

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"

RDF_TYPE = RDF + "type"
RDF_LANG_STRING = RDF + "langString"

SUB_PROPERTY_OF = RDFS + "subPropertyOf"
SUB_CLASS_OF = RDFS + "subClassOf"
DOMAIN = RDFS + "domain"
RANGE = RDFS + "range"

EQUIVALENT_PROPERTY = OWL + "equivalentProperty"
EQUIVALENT_CLASS = OWL + "equivalentClass"
INVERSE_OF = OWL + "inverseOf"
ON_PROPERTY = OWL + "onProperty"
HAS_VALUE = OWL + "hasValue"
ALL_VALUES_FROM = OWL + "allValuesFrom"

XSD_STRING = XSD + "string"
XSD_BOOLEAN = XSD + "boolean"
XSD_DATE = XSD + "date"
XSD_DATETIME = XSD + "dateTime"
XSD_DOUBLE = XSD + "double"
XSD_FLOAT = XSD + "float"
XSD_DECIMAL = XSD + "decimal"
XSD_INTEGER = XSD + "integer"
XSD_INT = XSD + "int"

# datatype name -> (lowest, highest) value, None = unlimited
INTEGER_RANGES = {
    "integer": (None, None),
    "long": (-(2**63), 2**63 - 1),
    "int": (-(2**31), 2**31 - 1),
    "short": (-(2**15), 2**15 - 1),
    "byte": (-(2**7), 2**7 - 1),
    "nonNegativeInteger": (0, None),
    "positiveInteger": (1, None),
    "nonPositiveInteger": (None, 0),
    "negativeInteger": (None, -1),
    "unsignedLong": (0, 2**64 - 1),
    "unsignedInt": (0, 2**32 - 1),
    "unsignedShort": (0, 2**16 - 1),
    "unsignedByte": (0, 2**8 - 1),
}
INTEGER_TYPES = tuple(XSD + name for name in INTEGER_RANGES)
NUMERIC_TYPES = INTEGER_TYPES + (XSD_DECIMAL, XSD_DOUBLE, XSD_FLOAT)
EXACT_TYPES = INTEGER_TYPES + (XSD_DECIMAL,)
TIME_TYPES = (XSD_DATE, XSD_DATETIME)

# Reserved by this library.
DEFAULT_GRAPH = "urn:x-default-graph"
BLANK_PREFIX = "urn:x-blank:"
