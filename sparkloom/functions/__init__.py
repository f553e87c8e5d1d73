"""Part of sparkloom."""
