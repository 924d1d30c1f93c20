"""Organization profiles (M02): resolve organizations to a single CRM account and attach
the account's attributes.

Every step is an aggregate with a HAVING-style filter (``count_distinct = 1``) or an
equi-join on account or organization id; the distinct counts are planned as two-phase
aggregations (de-duplicate (key, value) pairs map-side, then count), which keeps a hot
account or organization from landing whole in one task. Attribute look-ups are bounded
mapping tables, broadcast behind a size bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidpath.functions.rules import tier_from_label
from paidpath.operators.pickers import one_to_one_links, single_valued
from paidpath.session import materialize
from paidpath.operators.sizing import broadcast_if_bounded


def org_account_links(accounts: DataFrame, organizations: DataFrame) -> DataFrame:
    """(organization_id string, account_id) pairs that all sources agree on."""
    acc = accounts.select(F.col("id").alias("account_id"), F.col("organisation_id__c").alias("organization_id"))
    primary = one_to_one_links(acc, "account_id", "organization_id")            # 1 org <-> 1 account
    no_primary = acc.filter(F.col("organization_id").isNull()).select("account_id").distinct()
    orgs = organizations.select(F.col("organization_id__c").alias("organization_id"),
                                F.col("account__c").alias("account_id"))
    orgs_one = single_valued(orgs, "organization_id", "account_id")              # orgs with one account
    with_primary = orgs_one.join(primary.select("account_id"), "account_id")
    without_primary = orgs_one.join(no_primary, "account_id", "left_semi")
    combined = (primary.select(F.col("organization_id").cast("string").alias("organization_id"), "account_id")
                .unionByName(with_primary.select(F.col("organization_id").cast("string").alias("organization_id"),
                                                 "account_id"))
                .unionByName(without_primary.select(F.col("organization_id").cast("string").alias("organization_id"),
                                                    "account_id"))
                .distinct())
    return single_valued(combined, "organization_id", "account_id")


def org_profiles(accounts: DataFrame, organizations: DataFrame, industry_map: DataFrame,
                 size_map: DataFrame) -> DataFrame:
    """Every known organization id; account, country, industry, size and tier where
    the organization resolves to exactly one account.

    Account attributes are the account's last non-null values with no defined order in
    the source (T7); we take ``max`` so duplicate account rows cannot make runs differ.
    The account id is a key there, so an organization has one output row however often its
    account is given."""
    # the account rows feed six aggregates and joins: write the needed columns once
    accounts = materialize(accounts.select("id", "organisation_id__c", "icp_tier__c", "industry",
                                           "no_of_employees__c", "billingcountry"), "crm_accounts")
    links = materialize(org_account_links(accounts, organizations), "org_account_links")  # read twice below
    full = (accounts.filter(F.col("organisation_id__c").isNotNull())
            .select(F.col("organisation_id__c").cast("string").alias("organization_id"))
            .unionByName(organizations.select(F.col("organization_id__c").cast("string").alias("organization_id")))
            .distinct())
    props = accounts.groupBy(F.col("id").alias("account_id")).agg(
        F.max("icp_tier__c").alias("icp_tier__c"), F.max("industry").alias("industry__c"),
        F.max("no_of_employees__c").alias("no_of_employees__c"), F.max("billingcountry").alias("country"))
    base = (links.join(props, "account_id", "left")
                .join(broadcast_if_bounded(size_map), F.col("no_of_employees__c") == F.col("legacy_sf_emps"), "left")
                .join(broadcast_if_bounded(industry_map), F.col("industry__c") == F.col("legacy_sf_industry"), "left")
                .select("organization_id", "account_id", "country",
                        F.col("current_sf_industry").alias("industry"),
                        F.col("current_sf_emps").alias("no_of_employees"), "icp_tier__c"))
    out = full.join(base, "organization_id", "left")
    return out.select("organization_id", "account_id", "country", "industry", "no_of_employees",
                      tier_from_label("icp_tier__c").alias("icp_tiers"))
