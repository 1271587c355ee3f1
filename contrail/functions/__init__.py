"""Column expressions (JVM-side, codegen-friendly): decode casts, derivations,
zone-free time rendering and the SQL guard rules."""

from contrail.functions import audit, decode, status, time  # noqa: F401
