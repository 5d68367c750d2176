"""Key catalogue of the appraisal district's yearly tables.

The keys are *declared* here and *enforced* by DataFrame operators
(``parcelkit.operators.integrity``), never by storage.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class KeySpec:
    primary_key: tuple[str, ...] = ()
    # (child columns, parent table, parent columns)
    foreign_keys: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = field(default_factory=tuple)

    @property
    def single_column_fks(self):
        """Only single-column foreign keys are enforced at load (composite ones are reported only)."""
        return tuple(fk for fk in self.foreign_keys if len(fk[0]) == 1 and len(fk[2]) == 1)


def _fk_real(*cols):
    return ((tuple(cols), "real_acct", tuple(cols)),)


def _fk_bus():
    return ((("acct",), "t_business_acct", ("acct",)),)


# --- fixed values: primary and foreign keys of the 67 codebook tables -------
# (table -> primary key columns; foreign keys as child cols -> parent table cols)
KEYS: dict[str, KeySpec] = {
    "real_acct": KeySpec(("acct",)),
    "building_res": KeySpec(("acct", "bld_num"), _fk_real("acct")),
    "building_other": KeySpec(("acct", "bld_num"), _fk_real("acct")),
    "fixtures": KeySpec(("acct", "bld_num", "type"), ((("acct", "bld_num"), "building_res", ("acct", "bld_num")),)),
    "exterior": KeySpec(("acct", "bld_num", "sar_cd"), ((("acct", "bld_num"), "building_res", ("acct", "bld_num")),)),
    "structural_elem1": KeySpec(("acct", "bld_num", "code"), ((("acct", "bld_num"), "building_res", ("acct", "bld_num")),)),
    "structural_elem2": KeySpec(("acct", "bld_num", "code"), ((("acct", "bld_num"), "building_res", ("acct", "bld_num")),)),
    "extra_features": KeySpec(("acct", "cd"), _fk_real("acct")),
    "extra_features_detail1": KeySpec(("acct", "cd", "bld_num"), ((("acct", "cd"), "extra_features", ("acct", "cd")),)),
    "extra_features_detail2": KeySpec(("acct", "cd", "bld_num"), ((("acct", "cd"), "extra_features", ("acct", "cd")),)),
    "land": KeySpec(("acct", "num"), _fk_real("acct")),
    "land_ag": KeySpec(("acct", "num"), _fk_real("acct")),
    "jur_value": KeySpec(("acct", "tax_district"), _fk_real("acct")),
    "jur_exempt": KeySpec(("acct", "tax_district", "exempt_cat"), _fk_real("acct")),
    "jur_exempt_cd": KeySpec(("acct", "exempt_cat"), _fk_real("acct")),
    "jur_exemption_dscr": KeySpec(("exempt_cat",)),
    "jur_tax_dist_exempt_value_rate": KeySpec(()),
    "owners": KeySpec(("acct", "ln_num"), _fk_real("acct")),
    "deeds": KeySpec(("acct", "deed_id"), _fk_real("acct")),
    "ownership_history": KeySpec(("acct", "purchase_date"), _fk_real("acct")),
    "permits": KeySpec(("acct", "id"), _fk_real("acct")),
    "parcel_tieback": KeySpec(("acct", "related_acct"), _fk_real("acct")),
    "real_mnrl": KeySpec(("acct",), _fk_real("acct")),
    "real_neighborhood_code": KeySpec(("cd",)),
    "t_business_acct": KeySpec(("acct",)),
    "t_business_detail": KeySpec(("acct", "ln_num"), _fk_bus()),
    "t_jur_value": KeySpec(("acct", "tax_dist"), _fk_bus()),
    "t_jur_exempt": KeySpec(("acct", "tax_dist", "exempt_cat"), _fk_bus()),
    "t_jur_tax_dist_exempt_value_rate": KeySpec(()),
    "t_pp_e": KeySpec(()),
    "t_pp_l": KeySpec(("acct",), _fk_bus()),
    "arb_hearings_pp": KeySpec(("acct", "Tax_Year", "Personal"), _fk_bus()),
    "arb_hearings_real": KeySpec(("acct", "Tax_Year", "Real_Personal_Property"), _fk_real("acct")),
    "arb_protest_pp": KeySpec(("acct", "protested_dt"), _fk_bus()),
    "arb_protest_real": KeySpec(("acct", "protested_dt"), _fk_real("acct")),
    "desc_r_01_state_class": KeySpec(("Code",)),
    "desc_r_02_building_type_code": KeySpec(("Type",)),
    "desc_r_03_building_style": KeySpec(("Code",)),
    "desc_r_04_building_class": KeySpec(("Class",)),
    "desc_r_05_building_data_elements": KeySpec(("Code",)),
    "desc_r_06_structural_element_type": KeySpec(("Type",)),
    "desc_r_07_quality_code": KeySpec(("Code",)),
    "desc_r_08_pgi_category": KeySpec(("Category",)),
    "desc_r_09_subarea_type": KeySpec(("Type",)),
    "desc_r_10_extra_features": KeySpec(("Code",)),
    "desc_r_11_extra_feature_category": KeySpec(("Category",)),
    "desc_r_12_real_jurisdictions": KeySpec(("Code",)),
    "desc_r_13_real_jurisdiction_type": KeySpec(("Type",)),
    "desc_r_14_exemption_category": KeySpec(("Category",)),
    "desc_r_15_land_usecode": KeySpec(("Code",)),
    "desc_r_16_influence_factors": KeySpec(("UseCd", "InfCd")),
    "desc_r_17_relationship_type": KeySpec(("Type",)),
    "desc_r_18_permit_status": KeySpec(("Code",)),
    "desc_r_19_permit_code": KeySpec(("Code",)),
    "desc_r_20_school_district": KeySpec(("Code",)),
    "desc_r_21_market_area": KeySpec(("MktArea",)),
    "desc_r_22_hisd_section": KeySpec(("Code",)),
    "desc_r_23_special_codes": KeySpec(("Code",)),
    "desc_r_24_agent_roles": KeySpec(("Code",)),
    "desc_r_25_conclusion_code": KeySpec(("Code",)),
    "desc_r_26_neighborhood_num_adjust": KeySpec(("Neighborhood", "Class")),
    "desc_t_01_state_class": KeySpec(("Code",)),
    "desc_t_02_schedule_code": KeySpec(("Code",)),
    "desc_t_03_sic_code": KeySpec(("Type",)),
    "desc_t_04_department_group": KeySpec(("Code",)),
    "desc_t_05_jurisdictions": KeySpec(("Code",)),
    "desc_t_06_jurisdiction_type": KeySpec(("Code",)),
}

# --- fixed values: residential state classes of the protest view ------------
RESIDENTIAL_CLASSES = ("A1", "A2", "A3", "A4", "B1", "B2", "B3", "B4")


def primary_key(table: str) -> tuple[str, ...]:
    return KEYS.get(table, KeySpec()).primary_key


def foreign_keys(tables) -> list[tuple[str, tuple[str, ...], str, tuple[str, ...]]]:
    """(child, its columns, parent, its columns) of every foreign key, composite ones too, within ``tables``."""
    names = set(tables)
    return [(t, tuple(cols), parent, tuple(parent_cols)) for t in sorted(names) if t in KEYS
            for cols, parent, parent_cols in KEYS[t].foreign_keys if parent in names]


def load_levels(tables) -> list[list[str]]:
    """Group table names into levels: every single-column FK parent sits in an earlier level.

    Tables of one level do not depend on each other and can be loaded concurrently.
    """
    names = set(tables)
    level: dict[str, int] = {}

    def depth(t, seen=()):
        if t in level:
            return level[t]
        parents = [p for _, p, _ in KEYS.get(t, KeySpec()).single_column_fks if p in names and p != t and p not in seen]
        level[t] = 0 if not parents else 1 + max(depth(p, seen + (t,)) for p in parents)
        return level[t]

    for t in names:
        depth(t)
    out: list[list[str]] = [[] for _ in range(max(level.values(), default=-1) + 1)]
    for t in sorted(names):
        out[level[t]].append(t)
    return out


def parents_first(tables) -> list[str]:
    """Table names with every single-column FK parent before its children."""
    return [t for level in load_levels(tables) for t in level]
