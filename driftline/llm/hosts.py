"""Parts of host names that reputation is shared over."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public suffixes of two labels under which names are registered.
TWO_PART_SUFFIXES = (
    "ac.jp", "ac.nz", "ac.uk", "ac.za", "asn.au", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr", "co.nz", "co.th", "co.uk", "co.za",
    "com.ar", "com.au", "com.bd", "com.br", "com.cn", "com.co", "com.eg", "com.hk", "com.mx", "com.my", "com.ng", "com.pe", "com.ph", "com.pk",
    "com.pl", "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.vn", "edu.au", "edu.cn", "go.jp", "gob.mx", "gov.au", "gov.br", "gov.cn",
    "gov.in", "gov.uk", "id.au", "ltd.uk", "me.uk", "ne.jp", "net.au", "net.br", "net.cn", "net.in", "net.nz", "net.uk", "nhs.uk", "or.jp",
    "or.kr", "org.au", "org.br", "org.cn", "org.in", "org.mx", "org.nz", "org.tw", "org.uk", "org.za", "plc.uk", "sch.uk")


def host_levels(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host: the suffix is its last label, or its last two where these
    are a public suffix; the domain is the suffix and one label more, or the host where it has none."""
    parts = F.split(host, r"\.")

    def last(n: int) -> Column:
        size = F.size(parts)
        return F.array_join(F.slice(parts, F.greatest(size - (n - 1), F.lit(1)), F.lit(n)), ".")

    two = last(2).isin(*TWO_PART_SUFFIXES)
    return F.when(two, last(3)).otherwise(last(2)), F.when(two, last(2)).otherwise(last(1))


def host_suffixes(host: Column) -> Column:
    """The host and every domain above it, longest first."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
