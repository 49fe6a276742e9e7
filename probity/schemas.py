"""Table schemas. Nothing is inferred: sources are read and conformed with these."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
    "texts": T.ArrayType(T.StringType()),
}


def _schema(columns: str) -> T.StructType:
    """``name type, ...`` for flat tables; needs no session, unlike DDL."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _texts(names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names.split()])


# Column names and order of the layers.
SILVER = _schema(
    """dni string, nombres string, apellido_paterno string, apellido_materno string,
    fecha_nacimiento string, cargo string, partido string, ingresos_totales double,
    cantidad_bienes bigint, valor_total_bienes double, conteo_sentencias bigint,
    experiencia_publica_anios bigint, cantidad_renuncias bigint, source_category string,
    global_id string"""
)

GOLD = _schema(
    """global_id string, dni string, nombres string, apellido_paterno string,
    apellido_materno string, partido string, cargo string, source_category string,
    ingresos_totales double, valor_total_bienes double, conteo_sentencias bigint,
    experiencia_publica_anios bigint, cantidad_renuncias bigint, score_financiero double,
    score_legal double, score_estabilidad double, score_itr double, risk_flags texts,
    search_context string, osce_match_score double,
    ruc_sancionado string, fup_url string, osce_match_method string,
    osce_sancionada_match string"""
)

SANCTIONS = _schema(
    """ruc string, nombre_empresa string, tipo_sancion string, fecha_inicio string,
    fecha_fin string, motivo string, monto double, numero_resolucion string,
    nombre_empresa_norm string"""
)

PENALTIES = _schema(
    """ruc string, nombre_empresa string, tipo_penalidad string, entidad_contratante string,
    fecha_penalidad string, descripcion string, monto double, nombre_empresa_norm string"""
)

CONSORTIA = _schema(
    "anio bigint, ruc_consorcio string, consorcio string, ruc_miembro string, miembro string"
)

COMPANY_LINKS = _schema("numero_documento string, ruc string, nombre_empresa string")

MATCHES = _schema(
    """global_id string, empresa_candidato string, osce_sancionada_match string,
    osce_match_score double, ruc_sancionado string, tipo_sancion string,
    osce_match_method string, fup_url string"""
)

PLANS = _schema(
    """id_organizacion_politica string, dimension_social string, dimension_economica string,
    dimension_ambiental string, dimension_institucional string"""
)

# Personal fields of a résumé and the Silver columns they become.
PERSONAL_FIELDS = {
    "strDocumentoIdentidad": "dni",
    "strNombres": "nombres",
    "strApellidoPaterno": "apellido_paterno",
    "strApellidoMaterno": "apellido_materno",
    "strFechaNacimiento": "fecha_nacimiento",
    "strCargoEleccion": "cargo",
    "strOrganizacionPolitica": "partido",
}

# A résumé record. Numbers arrive as text or as JSON numbers: both are read as text.
_FREE = T.MapType(T.StringType(), T.StringType())
RESUME = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in {
            "oDatosPersonales": T.StructType(
                [
                    T.StructField("idHojaVida", T.LongType()),
                    *_texts("idOrganizacionPolitica " + " ".join(PERSONAL_FIELDS)).fields,
                ]
            ),
            "oIngresos": _texts(
                "strAnioIngresos decRemuBrutaPublico decRemuBrutaPrivado decRentaIndividualPublico "
                "decRentaIndividualPrivado decOtroIngresoPublico decOtroIngresoPrivado"
            ),
            "lExperienciaLaboral": T.ArrayType(
                _texts(
                    "strCentroTrabajo strOcupacionProfesion strAnioTrabajoDesde strAnioTrabajoHasta "
                    "strUbigeoTrabajo strTrabajoDepartamento strSector intAnioTrabajo"
                )
            ),
            "lEduUniversitaria": T.ArrayType(
                _texts("strUniversidad strCarreraUni strConcluidoEduUni strAnioBachiller strAnioTitulo")
            ),
            "lBienInmueble": T.ArrayType(
                _texts("strTipoBienInmueble strInmuebleDireccion decValor decAutovaluo")
            ),
            "lBienMueble": T.ArrayType(_texts("strVehiculo strPlaca decValor")),
            "lTitularidad": T.ArrayType(
                _texts("strPersonaJuridica strTipoTitularidad decCantidad decValor")
            ),
            "lAnotacionMarginal": T.ArrayType(_FREE),
            "oEduBasica": _FREE,
            "oEduTecnico": _FREE,
            "lEduPosgrado": T.ArrayType(_FREE),
            "lCargoPartidario": T.ArrayType(_FREE),
            "lRenunciaOP": T.ArrayType(_FREE),
            "lSentenciaPenal": T.ArrayType(_FREE),
            "lSentenciaObliga": T.ArrayType(_FREE),
        }.items()
    ]
)

# Source field -> (domain field, type) per résumé section. A number that is
# absent or unreadable becomes 0.
SECTIONS: dict[str, dict[str, tuple[str, str]]] = {
    "experiencia_laboral": {
        "strCentroTrabajo": ("centro_trabajo", "string"),
        "strOcupacionProfesion": ("ocupacion", "string"),
        "strAnioTrabajoDesde": ("anio_desde", "string"),
        "strAnioTrabajoHasta": ("anio_hasta", "string"),
        "strUbigeoTrabajo": ("ubigeo", "string"),
        "strTrabajoDepartamento": ("departamento", "string"),
    },
    "educacion_universitaria": {
        "strUniversidad": ("universidad", "string"),
        "strCarreraUni": ("carrera", "string"),
        "strConcluidoEduUni": ("concluido", "string"),
        "strAnioBachiller": ("anio_bachiller", "string"),
        "strAnioTitulo": ("anio_titulo", "string"),
    },
    "ingresos": {
        "strAnioIngresos": ("anio", "string"),
        "decRemuBrutaPublico": ("remu_publico", "double"),
        "decRemuBrutaPrivado": ("remu_privado", "double"),
        "decRentaIndividualPublico": ("renta_publico", "double"),
        "decRentaIndividualPrivado": ("renta_privado", "double"),
        "decOtroIngresoPublico": ("otro_publico", "double"),
        "decOtroIngresoPrivado": ("otro_privado", "double"),
    },
    "bienes_inmuebles": {
        "strTipoBienInmueble": ("tipo", "string"),
        "strInmuebleDireccion": ("direccion", "string"),
        "decValor": ("valor", "double"),
        "decAutovaluo": ("autovaluo", "double"),
    },
    "bienes_muebles": {
        "strVehiculo": ("tipo", "string"),
        "strPlaca": ("placa", "string"),
        "decValor": ("valor", "double"),
    },
    "titularidades": {
        "strPersonaJuridica": ("empresa", "string"),
        "strTipoTitularidad": ("tipo", "string"),
        "decCantidad": ("cantidad", "double"),
        "decValor": ("valor", "double"),
    },
    "datos_personales": {
        "idHojaVida": ("id_hoja_vida", "bigint"),
        "strDocumentoIdentidad": ("dni", "string"),
        "strApellidoPaterno": ("apellido_paterno", "string"),
        "strApellidoMaterno": ("apellido_materno", "string"),
        "strNombres": ("nombres", "string"),
        "strFechaNacimiento": ("fecha_nacimiento", "string"),
        "strOrganizacionPolitica": ("partido", "string"),
        "strCargoEleccion": ("cargo_postula", "string"),
    },
    "candidato_lista": {
        "idProcesoElectoral": ("id_proceso_electoral", "bigint"),
        "idTipoEleccion": ("id_tipo_eleccion", "bigint"),
        "idOrganizacionPolitica": ("id_organizacion_politica", "bigint"),
        "strOrganizacionPolitica": ("organizacion_politica", "string"),
        "idCargo": ("id_cargo", "bigint"),
        "strCargo": ("cargo", "string"),
        "strDocumentoIdentidad": ("dni", "string"),
        "strNombres": ("nombres", "string"),
        "strApellidoPaterno": ("apellido_paterno", "string"),
        "strApellidoMaterno": ("apellido_materno", "string"),
        "strSexo": ("sexo", "string"),
        "strEstadoCandidato": ("estado_candidato", "string"),
    },
    "plan_gobierno": {
        "idPlanGobierno": ("id_plan_gobierno", "bigint"),
        "idOrganizacionPolitica": ("id_organizacion_politica", "bigint"),
        "txOrganizacionPolitica": ("organizacion_politica", "string"),
        "txRutaResumen": ("ruta_pdf", "string"),
    },
    "anotacion_marginal": {
        "idAnotacionMarginal": ("id_anotacion", "bigint"),
        "strDice": ("dice", "string"),
        "strDebeDecir": ("debe_decir", "string"),
        "strI_Expediente": ("expediente", "string"),
        "strI_Ruta": ("ruta_anotacion", "string"),
    },
}

# Parts of a fetched profile -> résumé columns.
PROFILE_PARTS = {
    "experiencia_laboral": "lExperienciaLaboral",
    "educacion_universitaria": "lEduUniversitaria",
    "ingresos": "oIngresos",
    "bienes_inmuebles": "lBienInmueble",
    "bienes_muebles": "lBienMueble",
    "educacion_basica": "oEduBasica",
    "educacion_tecnica": "oEduTecnico",
    "posgrado": "lEduPosgrado",
    "cargo_partidario": "lCargoPartidario",
    "sentencia_penal": "lSentenciaPenal",
    "sentencia_obliga": "lSentenciaObliga",
    "anotacion_marginal": "lAnotacionMarginal",
}
