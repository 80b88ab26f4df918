"""Tenancy: a discriminator column, a storage root per tenant, or neither."""

from __future__ import annotations

import base64
import re
from typing import Any

from tenantgraph.errors import TenantRequired

MAX_NAME = 128


def normalise(tenant: Any) -> str | int:
    """A usable tenant, or an error that doesn't repeat it."""
    if tenant is None or tenant is False or isinstance(tenant, str) and not tenant.strip():
        raise TenantRequired("tenant_required")
    tenant = getattr(tenant, "tenant_key", tenant)
    if isinstance(tenant, bool) or not isinstance(tenant, (str, int)):
        raise TenantRequired("tenant_required")
    return tenant


def database_of(tenant: Any) -> str:
    """The storage name of a tenant, injective on strings: plain names get one prefix, all others another and base 32."""
    name = str(normalise(tenant))
    out = f"t_{name}" if re.fullmatch(r"[A-Za-z0-9_]+", name) else "g" + base64.b32encode(name.encode()).decode().rstrip("=").lower()
    if len(out.encode()) > MAX_NAME:
        raise TenantRequired("tenant_name_too_long")
    return out
