"""Service names of ports and names of IP protocols."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Service shown for a destination port.
SERVICES = {
    20: "FTP-DATA",
    21: "FTP",
    22: "SSH",
    23: "TELNET",
    25: "SMTP",
    53: "DNS",
    67: "DHCP-SERVER",
    68: "DHCP-CLIENT",
    69: "TFTP",
    80: "HTTP",
    110: "POP3",
    123: "NTP",
    143: "IMAP",
    161: "SNMP",
    162: "SNMP-TRAP",
    389: "LDAP",
    443: "HTTPS",
    445: "SMB",
    465: "SMTPS",
    514: "SYSLOG",
    587: "SMTP-SUBMISSION",
    636: "LDAPS",
    993: "IMAPS",
    995: "POP3S",
    1433: "MSSQL",
    1521: "ORACLE",
    3306: "MYSQL",
    3389: "RDP",
    5432: "POSTGRESQL",
    5900: "VNC",
    6379: "REDIS",
    8080: "HTTP-ALT",
    8443: "HTTPS-ALT",
    9200: "ELASTICSEARCH",
    27017: "MONGODB",
}

# Name shown for an IP protocol number.
PROTOCOLS = {
    0: "HOPOPT",
    1: "ICMP",
    2: "IGMP",
    6: "TCP",
    17: "UDP",
    41: "IPv6",
    47: "GRE",
    50: "ESP",
    51: "AH",
    58: "ICMPv6",
    89: "OSPF",
    103: "PIM",
    112: "VRRP",
    132: "SCTP",
}


def _lookup(names: dict[int, str], key: Column) -> Column:
    """Name of ``key``, null if it has none.  A literal map: no join, no shuffle."""
    entries = F.create_map(*[F.lit(item) for item in chain.from_iterable(names.items())])
    return F.element_at(entries, key.cast("int"))


def service_name(port: Column) -> Column:
    """Known service, else the port as text (null for a null port)."""
    return F.coalesce(_lookup(SERVICES, port), port.cast("string"))


def protocol_name(proto: Column) -> Column:
    """Known protocol, else ``PROTO-<n>``; a null number gives just ``PROTO-``."""
    number = F.coalesce(proto.cast("string"), F.lit(""))
    return F.coalesce(_lookup(PROTOCOLS, proto), F.concat(F.lit("PROTO-"), number))
